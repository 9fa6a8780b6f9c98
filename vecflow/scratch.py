"""Where intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: For tables of whole texts, which stay until the session ends.
TEXTS = "zstd"
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a session that runs on one
    machine and names none gets a temporary folder of its own."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="vecflow-")
    return _local_roots[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no earlier call returned."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut lineage through a written table, so a lost executor costs a re-read only. Without a ``compression`` that of the
    session holds."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
