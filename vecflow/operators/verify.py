"""Checking a copy against its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.plans.ranges import constant_array

STATUSES = (
    "match",
    "missing",
    "unexpected",
    "payload_differs",
    "vector_differs",
    "shard_differs",
    "duplicate",
)


def exact_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("points"))


def observe_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and a count that is there once they have been written.

    ``observation.get["points"]`` comes out of the write itself, with no second pass.
    """
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("points")), observation


def count_check(source: DataFrame, target: DataFrame, *keys: str) -> DataFrame:
    """Source and target counts side by side, per ``keys`` if any, with a verdict."""
    both = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    counted = both.groupBy(*keys).agg(
        F.coalesce(F.sum("_s"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("target_count"),
    )
    equal = F.col("source_count") == F.col("target_count")
    return counted.withColumn("status", F.when(equal, "equal").otherwise("different"))


def vector_parts(points: DataFrame) -> list[Column]:
    """All vectors of a point in a fixed order: kinds as listed, names sorted."""
    parts = []
    for column in ("dense", "sparse", "multi"):
        if column in points.columns:
            empty = F.create_map().cast(points.schema[column].dataType)
            parts.append(F.sort_array(F.map_entries(F.coalesce(F.col(column), empty))))
    return parts


def digests(points: DataFrame) -> DataFrame:
    """Points cut down to an id and 128 bits each for vectors, payload and shard key.

    Floats are compared bit for bit; payload text prints object keys sorted, so
    their order does not count. Plain numbers keep the comparison in a hash
    aggregation.
    """
    vectors, text = vector_parts(points), F.to_json(F.col("payload"))
    second, shard = F.lit("second"), [F.lit(""), F.lit("")]
    if "shard_key" in points.columns:  # absent and null parts become the same marks
        keyword, number = F.col("shard_key.keyword"), F.col("shard_key.num").cast("string")
        shard = [F.coalesce(F.concat(F.lit("="), part), F.lit("")) for part in (keyword, number)]
    return points.select(
        "id",
        F.xxhash64(*vectors).alias("v1"),
        F.xxhash64(second, *vectors).alias("v2"),
        F.xxhash64(text).alias("p1"),
        F.xxhash64(second, text).alias("p2"),
        F.xxhash64(*shard).alias("s1"),
        F.xxhash64(second, *shard).alias("s2"),
    )


def compare(source: DataFrame, target: DataFrame) -> DataFrame:
    """``(id, status)`` for every id on either side.

    Both sides are cut to digests and grouped by id in one aggregation: vectors
    never cross the network, and an id repeated without end is combined before
    the shuffle.
    """
    tagged = digests(source).withColumn("_side", F.lit(1)).unionByName(
        digests(target).withColumn("_side", F.lit(2))
    )
    parts = ("v1", "v2", "p1", "p2", "s1", "s2")
    grouped = tagged.groupBy("id").agg(
        F.count(F.when(F.col("_side") == 1, 1)).alias("_s"),
        F.count(F.when(F.col("_side") == 2, 1)).alias("_t"),
        *[F.min(part).alias(f"{part}_low") for part in parts],
        *[F.max(part).alias(f"{part}_high") for part in parts],
    )

    def differ(*names: str) -> Column:
        first, second = [F.col(f"{n}_low") != F.col(f"{n}_high") for n in names]
        return first | second

    status = (
        F.when(F.col("_t") == 0, "missing")
        .when(F.col("_s") == 0, "unexpected")
        .when((F.col("_s") > 1) | (F.col("_t") > 1), "duplicate")
        .when(differ("v1", "v2"), "vector_differs")
        .when(differ("p1", "p2"), "payload_differs")
        .when(differ("s1", "s2"), "shard_differs")
        .otherwise("match")
    )
    return grouped.select("id", status.alias("status"))


def reconcile_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """Number of ids per status."""
    return compare(source, target).groupBy("status").agg(F.count(F.lit(1)).alias("points"))


DIFFERING_BUCKETS = 1 << 12


def bucket_sums(points: DataFrame, buckets: int) -> DataFrame:
    """Points per bucket of their ids and order-free sums of 128 bits of each point; a row per bucket and task moves."""
    parts = ("v1", "v2", "p1", "p2", "s1", "s2")
    whole = digests(points)
    first, second = F.xxhash64("id", *parts), F.xxhash64(F.lit("second"), "id", *parts)
    sums = [F.sum(h.cast("decimal(38,0)")).alias(name) for name, h in (("d1", first), ("d2", second))]
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket")
    return whole.groupBy(bucket).agg(F.count(F.lit(1)).alias("points"), *sums)


def compare_buckets(source: DataFrame, target: DataFrame, buckets: int = DIFFERING_BUCKETS) -> DataFrame:
    """``(bucket, source_points, target_points, equal)`` for each bucket of ids that holds points of either side."""
    names = ("points", "d1", "d2")
    left, right = bucket_sums(source, buckets), bucket_sums(target, buckets)
    left = left.select("bucket", *[F.col(c).alias(f"{c}_s") for c in names])
    right = right.select("bucket", *[F.col(c).alias(f"{c}_t") for c in names])
    equal = F.lit(True)
    for name in names:
        equal = equal & F.col(f"{name}_s").eqNullSafe(F.col(f"{name}_t"))
    zero = F.lit(0).cast("bigint")
    return left.join(right, "bucket", "full_outer").select(
        "bucket",
        F.coalesce("points_s", zero).alias("source_points"),
        F.coalesce("points_t", zero).alias("target_points"),
        equal.alias("equal"),
    )


def reconcile_by_buckets(source: DataFrame, target: DataFrame, buckets: int = DIFFERING_BUCKETS) -> DataFrame:
    """``reconcile_report`` for copies that should agree: only buckets that differ are compared id by id.

    Both sides are read once for sums per bucket, and again, id by id, for the buckets whose sums differ; their numbers,
    at most ``buckets``, are a constant of that second pass. Points of a bucket that agrees are matches, which includes
    an id that both sides repeat alike. With equal copies no id crosses the network.
    """
    found = compare_buckets(source, target, buckets).collect()
    alike = sum(r["source_points"] for r in found if r["equal"])
    differing = [r["bucket"] for r in found if not r["equal"]]
    schema = "status string, points bigint"
    matches = source.sparkSession.createDataFrame([("match", alike)] if alike else [], schema)
    if not differing:
        return matches
    flags = [False] * buckets
    for bucket in differing:
        flags[bucket] = True
    differs = F.get(constant_array(flags, T.BooleanType()), F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    rest = reconcile_report(source.where(differs), target.where(differs))
    return matches.unionByName(rest).groupBy("status").agg(F.sum("points").alias("points"))


def vectors_within(left: Column, right: Column, relative: float) -> Column:
    """Whether two dense vectors agree within a relative tolerance per element."""
    pairs = F.zip_with(
        left, right, lambda a, b: F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))
    )
    return F.size(left).eqNullSafe(F.size(right)) & F.forall(
        pairs, lambda ok: F.coalesce(ok, F.lit(False))
    )


def compare_within(
    source: DataFrame, target: DataFrame, vector: str, relative: float = 1e-2
) -> DataFrame:
    """Comparison of one dense vector by value, for targets that store fewer digits."""
    name = F.lit(vector)

    def side(points: DataFrame, value: str, count: str) -> DataFrame:
        of_id = points.select("id", F.col("dense")[name].alias("_v")).groupBy("id")
        return of_id.agg(F.max("_v").alias(value), F.count(F.lit(1)).alias(count))

    joined = side(source, "_l", "_s").join(side(target, "_r", "_t"), "id", "full_outer")
    both_absent = F.col("_l").isNull() & F.col("_r").isNull()
    close = both_absent | F.coalesce(vectors_within(F.col("_l"), F.col("_r"), relative), F.lit(False))
    status = (
        F.when(F.col("_t").isNull(), "missing")
        .when(F.col("_s").isNull(), "unexpected")
        .when((F.col("_s") > 1) | (F.col("_t") > 1), "duplicate")
        .when(close, "match")
        .otherwise("vector_differs")
    )
    return joined.select("id", status.alias("status"))
