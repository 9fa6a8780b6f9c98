"""Progress of a copy, per source, plan and range, in an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecflow.operators.upsert import keep_last
from vecflow.schema import PROGRESS

KEYS = ["source_key", "plan_id", "range_id"]


class ProgressTable:
    """Rows are only ever added, always after the data they speak of is committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _history(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(self.path)

    def store(self, rows: DataFrame) -> None:
        """Append progress rows ``(source_key, plan_id, range_id, last_key, processed)``."""
        rows.withColumn("updated_at", F.current_timestamp()).select(
            *KEYS, "last_key", F.col("processed").cast("bigint"), "updated_at"
        ).coalesce(1).write.mode("append").parquet(self.path)

    def load(self, restart: bool = False) -> DataFrame:
        """Latest complete row of every range; with ``restart``, none."""
        history = self._history()
        return latest_progress(history.limit(0) if restart else history)

    def clear(self, source_key: str, plan_id: str) -> None:
        """Forget one plan of one source by writing an empty row over each of its ranges."""
        cleared = (
            self.load()
            .where((F.col("source_key") == source_key) & (F.col("plan_id") == plan_id))
            .withColumn("last_key", F.lit(None).cast("string"))
            .withColumn("processed", F.lit(None).cast("bigint"))
        )
        self.store(cleared)


def latest_progress(history: DataFrame) -> DataFrame:
    """Last row per range; one without a key or a count means: from the beginning."""
    return keep_last(history, KEYS, ["updated_at", "processed"]).where(
        F.col("last_key").isNotNull() & F.col("processed").isNotNull()
    )


def without_plan(history: DataFrame, source_key: str, plan_id: str) -> DataFrame:
    """Progress of everything but one plan of one source."""
    return history.where((F.col("source_key") != source_key) | (F.col("plan_id") != plan_id))


def total_processed(progress: DataFrame) -> DataFrame:
    return progress.groupBy("source_key").agg(F.sum("processed").alias("processed"))


def cumulative_progress(batches: DataFrame, count: str = "points") -> DataFrame:
    """Running count per source over ``(source_key, range_id, batch)`` rows.

    Running sums stay inside a range; the ranges' own totals, a handful of rows
    per source, supply what came before. One busy source therefore still spreads
    over as many tasks as it has ranges.
    """
    by_range = Window.partitionBy("source_key", "range_id").orderBy("batch")
    earlier = Window.partitionBy("source_key").orderBy("range_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        batches.groupBy("source_key", "range_id")
        .agg(F.sum(count).alias("_total"))
        .select(
            "source_key",
            "range_id",
            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    running = batches.withColumn(
        "_running",
        F.sum(count).over(by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    return (
        running.join(before, ["source_key", "range_id"])
        .withColumn("processed", (F.col("_before") + F.col("_running")).cast("bigint"))
        .drop("_before", "_running")
    )
