"""The incremental form: new records are upserted as they arrive, then it stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecflow.operators.collection import StoredCollection


#: Where a streamed row came from: file time, path and offset in the file.
FILE = "_file"


def read_new_files(
    spark: SparkSession, path: str, schema, files_per_batch: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stream of a folder's files; ``files_per_batch`` bounds one micro-batch.

    Where a micro-batch can hold several files, the column ``_file`` tells later
    ones from earlier ones.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch is not None:
        if files_per_batch < 1:
            raise ValueError("files_per_batch must be positive")
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(path)
    if files_per_batch == 1:
        return rows
    parts = ("file_modification_time", "file_path", "file_block_start")
    return rows.withColumn(FILE, F.struct(*[F.col(f"_metadata.{p}") for p in parts]))


def in_arrival_order(batch: DataFrame) -> DataFrame:
    """Rows of earlier files first, and rows of a file as they stand in it.

    Spark packs files into tasks by size, so the order of tasks says nothing.
    """
    numbered = batch.withColumn("_row", F.monotonically_increasing_id())
    return numbered.orderBy(FILE, "_row").drop("_row")


def incremental_upsert(
    stream: DataFrame,
    target: StoredCollection,
    checkpoint: str,
    normalise: Callable[[DataFrame], DataFrame] = lambda df: df,
    seq: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into ``target``.

    The checkpoint remembers what was read, so a new run goes on after it; another
    checkpoint folder means a fresh start. A batch that is delivered again after
    a crash has the same effect as once. Without ``interval`` the query ends when
    nothing new is left; with it (``"30 seconds"``) batches are paced.

    Without ``seq`` the later file wins. A micro-batch of several files is sorted by
    arrival for that, which reads it twice; with ``seq`` nothing is sorted.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        if FILE in batch.columns:
            batch = (batch if seq else in_arrival_order(batch)).drop(FILE)
        target.upsert(normalise(batch), seq)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
