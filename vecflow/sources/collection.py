"""Points that are already in the canonical shape."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.schema import POINT_COLUMNS


def scan_points(spark: SparkSession, path: str) -> DataFrame:
    """Every point of a stored collection, with payload and vectors."""
    points = spark.read.parquet(path)
    missing = set(POINT_COLUMNS) - set(points.columns)
    if missing:
        raise ValueError(f"{path} lacks point columns {sorted(missing)}")
    return points


def select_partitions(df: DataFrame, column: str, names: Iterable[str]) -> DataFrame:
    """Restrict a scan to some namespaces, tenants or partitions; none listed means all."""
    names = list(names)
    return df.where(F.col(column).isin(*names)) if names else df


def fetch_by_ids(ids: DataFrame, store: DataFrame, key: str = "id") -> DataFrame:
    """Records of the listed ids, in full; an id without a record is left out.

    Neither side is forced to broadcast: Spark does so only when its own size
    estimate for the id list is small, and AQE re-checks it at run time. Ids are
    made distinct first, which combines a repeated one before the shuffle the
    join needs anyway.
    """
    return store.join(ids.select(key).distinct(), key, "left_semi")

