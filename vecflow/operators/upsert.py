"""Insert-or-replace by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_last(rows: DataFrame, key: str | Sequence[str], seq: str | Sequence[str]) -> DataFrame:
    """The last row per key.

    Spark limits each key to one row per task before the shuffle (the ``row_number
    = 1`` window is a group limit), so a key repeated in a third of the rows sends
    one row per task, not a third of the data.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in ([seq] if isinstance(seq, str) else seq)]
    last = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def merge_latest(target: DataFrame, latest: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``latest`` (unique by key) inserted or replaced."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.join(latest.select(*keys), keys, "left_anti").unionByName(latest)


def upsert(
    target: DataFrame, batch: DataFrame, key: str | Sequence[str], seq: str | Sequence[str]
) -> DataFrame:
    """Replace or insert ``batch`` into ``target``; repeated ids resolve to the later one.

    The plan reads ``batch`` twice, once for its keys alone. Write a batch that is
    costly to compute to a table first, as ``StoredCollection.upsert`` does.
    """
    latest = keep_last(batch, key, seq).select(*target.columns)
    return merge_latest(target, latest, key)
