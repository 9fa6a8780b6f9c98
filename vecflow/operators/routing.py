"""Which shard a point goes to, and writing one group per shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions.ids import id_text
from vecflow.schema import SHARD_KEY

MAX_RECORDS_PER_FILE = 5_000_000


def check_route_options(
    fixed: str | None, field: str | None, source: str | None = None, target: str | None = None
) -> None:
    """A fixed key and a key field exclude each other; a copy needs two collections."""
    if fixed and field:
        raise ValueError("give either a fixed shard key or a field to take it from")
    if source is not None and source == target:
        raise ValueError("a collection cannot be copied onto itself")


def _shard(keyword: Column | None = None, number: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None) if keyword is None else keyword).cast("string").alias("keyword"),
        (F.lit(None) if number is None else number).cast("decimal(20,0)").alias("num"),
    ).cast(SHARD_KEY)


def route_fixed(points: DataFrame, key: str) -> DataFrame:
    return points.withColumn("shard_key", _shard(keyword=F.lit(key)))


def route_preserve(points: DataFrame) -> DataFrame:
    """The source's own key is kept; it may be null."""
    return points


def field_shard(payload: Column, field: str) -> Column:
    """Non-empty text as keyword, non-negative integer as number, otherwise null."""
    value = payload_value(payload, field)
    kind = F.schema_of_variant(value)
    text = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
    number = F.when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    return F.when(text != "", _shard(keyword=text)).when(number >= 0, _shard(number=number))


def payload_value(payload: Column, field: str) -> Column:
    quoted = field.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(payload, f"$['{quoted}']", "variant")


def route_error(payload: Column, field: str, point_id: Column) -> Column:
    """Why a point cannot be routed by ``field``; null when it can."""
    value = payload_value(payload, field)
    prefix = F.concat(
        F.lit("no shard for point "), id_text(point_id), F.lit(f": field {field} ")
    )
    missing = value.isNull()
    return F.when(missing, F.concat(prefix, F.lit("is missing"))).when(
        field_shard(payload, field).isNull(),
        F.concat(prefix, F.lit("holds neither text nor a number from 0 on")),
    )


def route_by_field(points: DataFrame, field: str, mode: str = "fail") -> DataFrame:
    """Route by a payload field. ``fail`` stops at a point that has no usable value,
    ``quarantine`` leaves its shard key null and says why in ``reason``."""
    error = route_error(F.col("payload"), field, F.col("id"))
    shard = field_shard(F.col("payload"), field)
    if mode == "quarantine":
        return points.withColumn("reason", error).withColumn("shard_key", shard)
    if mode != "fail":
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    return points.withColumn(
        "shard_key", F.coalesce(shard, F.raise_error(error).cast(SHARD_KEY))
    )


def route(points: DataFrame, fixed: str | None = None, field: str | None = None) -> DataFrame:
    check_route_options(fixed, field)
    if fixed:
        return route_fixed(points, fixed)
    return route_by_field(points, field) if field else route_preserve(points)


def shard_text(shard_key: Column) -> Column:
    """Folder-safe name of a shard; keywords and numbers cannot meet."""
    return F.coalesce(
        F.concat(F.lit("k:"), shard_key["keyword"]),
        F.concat(F.lit("n:"), shard_key["num"].cast("string")),
    )


def group_by_shard(points: DataFrame) -> DataFrame:
    """Points per shard; those without a key are a group of their own."""
    return points.groupBy("shard_key").agg(F.count(F.lit(1)).alias("points"))


def new_shard_keys(points: DataFrame, known: DataFrame) -> DataFrame:
    """Shard keys in use that do not exist yet."""
    used = points.where(F.col("shard_key").isNotNull()).select("shard_key").distinct()
    return used.join(known.select("shard_key"), "shard_key", "left_anti")


def write_sharded(points: DataFrame, path: str, mode: str = "error") -> None:
    """One folder per shard.

    The rebalance splits a shard that holds much of the data over many tasks and
    packs small shards together, by the sizes seen at run time.
    """
    (
        points.withColumn("shard", shard_text(F.col("shard_key")))
        .hint("rebalance", "shard")
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("shard")
        .parquet(path)
    )


def read_sharded(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
