"""Removal of long lines that many documents share.

Lines are exploded, normalised and hashed, distinct documents are counted per hash, and the positions of the lines over
the threshold come back to their text, which is put together again without them.

* A line's key is the line without white space of the ASCII kinds at both ends, with A-Z in lower case.
* A key of at least ``least_chars`` code points in at least ``least_docs`` documents is dropped everywhere, but for the
  document with the largest id that holds it: there all its lines stay.
* A null or empty text has one empty line. Rows that share an id are one document where documents are counted, and each
  row is returned. Rows without an id are one document too, smaller than any with an id. An empty table gives no rows.
* Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.llm.common import lookup
from vecflow.scratch import materialize

WHITE = " \t\n\x0b\x0c\r"
#: A key that holds this part of all lines or more is hot; so at most this many keys are.
HOT_KEYS = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def wide_hash(*columns: str | Column) -> list[Column]:
    """128 bits of some columns, as two numbers."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def hashed_lines(rows: DataFrame, least_chars: int) -> DataFrame:
    """(r1, r2, doc_id, at, h1, h2) for every line long enough to be dropped; no text is carried along."""
    lines = rows.select("r1", "r2", "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(WHITE))).where(F.length("line") >= least_chars)
    h1, h2 = wide_hash(F.translate("line", UPPER, LOWER))
    return lines.select("r1", "r2", "doc_id", "at", h1.alias("h1"), h2.alias("h2"))


def frequent_keys(lines: DataFrame, least_docs: int) -> DataFrame:
    """(h1, h2, keeper, times) of the keys found in at least ``least_docs`` documents; a line for each of ``times``.

    A key is first counted by document, so the rows of a key that is everywhere are spread over all tasks and meet
    again as one partial count per task.
    """
    by_doc = lines.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    docs, times = F.count(F.lit(1)).alias("docs"), F.sum("times").alias("times")
    counted = by_doc.groupBy("h1", "h2").agg(docs, times, F.max("doc_id").alias("keeper"))
    return counted.where(F.col("docs") >= least_docs).drop("docs")


def drop_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for every row, the text without its dropped lines.

    Rows are matched with their dropped positions by 128 bits of id and text; rows equal in both lose the same lines.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    r1, r2 = wide_hash("doc_id", "text")
    rows = rows.withColumns({"r1": r1, "r2": r2})
    lines = materialize(hashed_lines(rows, least_chars), "lines")
    frequent = materialize(frequent_keys(lines, least_docs), "keys")
    dropped = (
        lookup(lines, frequent, ["h1", "h2"], "times", lines.count(), HOT_KEYS)
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("r1", "r2")
        .agg(F.collect_set("at").alias("dropped"))
    )
    split = rows.join(dropped, ["r1", "r2"], "left").select("doc_id", "text", "dropped", F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    left = split.withColumn("stay", F.when(F.col("dropped").isNotNull(), stay))
    text = F.array_join(F.transform("stay", lambda at: F.get(F.col("lines"), at)), "\n")
    return left.select(
        "doc_id",
        F.coalesce(text, "text").alias("text"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("stay"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
