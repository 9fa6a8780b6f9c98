"""The paths for large plans, hot ranges, listed ids and copies that agree, against the plain ones."""

import pytest
from pyspark.sql import functions as F

from vecflow.functions import ids
from vecflow.operators import verify
from vecflow.operators.collection import StoredCollection
from vecflow.plans import ranges
from vecflow.schema import to_points

KEYS = {
    "bigint": "id * 7 % 1009",
    "timestamp": "timestamp_micros(id * 7 % 1009 * 1800000123 + 1698500000000000)",
    "binary": "unhex(lpad(hex(id * 7 % 1009), 8, '0'))",
    "string": "concat('ké', id * 7 % 1009)",
    "decimal": "CAST(id * 7 % 1009 / 8 AS decimal(20,4))",
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("cells,spread", [(1, 1), (4, 16), (1000, 3)])
def test_merged_ranges_equal_searched_ones(spark, kind, cells, spread):
    rows = spark.range(1200).select(F.expr(KEYS[kind]).alias("k"), "id")
    hot = spark.range(300).selectExpr("40L AS id", "id + 5000 AS n").select(F.expr(KEYS[kind]).alias("k"), F.col("n").alias("id"))
    none = spark.range(1).select(F.lit(None).cast(rows.schema["k"].dataType).alias("k"), F.lit(9999).cast("bigint").alias("id"))
    rows = rows.unionByName(hot).unionByName(none)
    sample = rows.where("id % 13 = 0 AND k IS NOT NULL").select("k")
    plan = ranges.ranges_all_samples(sample, "k", "s")
    expected = {r["id"]: r["range_id"] for r in ranges.assign_range(rows, "k", plan).collect()}
    found = ranges.assign_range_merged(rows, "k", plan, cells, spread)
    assert found.columns == ["k", "id", "range_id"]
    assert {r["id"]: r["range_id"] for r in found.collect()} == expected


def test_merged_ranges_of_one_open_range_and_no_rows(spark):
    rows = spark.range(10).toDF("k")
    plan = ranges.ranges_all_samples(rows.limit(0), "k", "s")
    assert {r["range_id"] for r in ranges.assign_range_merged(rows, "k", plan).collect()} == {0}
    assert ranges.assign_range_merged(rows.limit(0), "k", plan).count() == 0


def test_a_hot_key_is_several_tasks(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 5).otherwise(F.col("id")).alias("k"))
    plan = ranges.ranges_all_samples(spark.createDataFrame([(3,), (500,), (950,)], "k bigint"), "k", "s")
    found = ranges.assign_range_merged(rows, "k", plan, cells=2, spread=10)
    assert found.groupBy("range_id").count().orderBy("range_id").collect() == [(1, 900), (2, 51), (3, 49)]
    text = found._jdf.queryExecution().analyzed().toString()
    assert "_part" in text and "Window" in text


@pytest.mark.parametrize("parts,key", [(1, "id"), (2, "id"), (64, "id"), (7, "concat('x', id)"), (7, "CAST(id / 4 AS decimal(12,3))")])
def test_batches_of_a_hot_range_equal_those_of_one_window(spark, parts, key):
    rows = spark.range(500).select(F.expr(key).alias("k"), F.when(F.col("id") % 10 == 3, 1).otherwise(0).alias("range_id"), "id")
    plain = {r["id"]: r["batch"] for r in ranges.batch_number(rows, "k", 17).collect()}
    cut = ranges.batch_number(rows, "k", 17, parts=parts)
    assert cut.columns == ["k", "range_id", "id", "batch"]
    assert {r["id"]: r["batch"] for r in cut.collect()} == plain


def test_batches_in_parts_of_nothing(spark):
    rows = spark.range(0).select(F.col("id").alias("k"), F.lit(0).alias("range_id"))
    assert ranges.batch_number(rows, "k", 5, parts=4).count() == 0
    with pytest.raises(ValueError):
        ranges.batch_number(rows, "k", 5, parts=0)


def points(rows):
    return to_points(rows, id=ids.numeric_id(F.col("id")), payload=F.to_variant_object(F.struct("id", "v")))


def test_listed_ids_read_their_own_buckets_only(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=128)
    rows = spark.range(600).withColumn("v", F.lit("a"))
    target.upsert(points(rows))
    target.upsert(points(rows.where("id % 5 = 0").withColumn("v", F.lit("b"))))
    listed = spark.createDataFrame([(3,), (5,), (5,), (10,), (7000,), (None,)], "id bigint").select(
        F.when(F.col("id").isNotNull(), ids.numeric_id(F.col("id"))).alias("id")
    )
    found = target.fetch(listed)
    got = {int(r["id"]["num"]): r["v"] for r in found.select("id", F.try_variant_get("payload", "$.v", "string").alias("v")).collect()}
    assert got == {3: "a", 5: "b", 10: "b"}
    folders = {p.split("bucket=")[1].split("/")[0] for p in found.inputFiles() if "bucket=" in p}
    assert len(folders) <= 4
    assert found.columns == target.points().columns
    assert target.fetch(listed.limit(0)).count() == 0
    assert StoredCollection(spark, str(tmp_path / "none")).fetch(listed).count() == 0


def test_all_listed_ids_are_the_whole_collection(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=4)
    target.upsert(points(spark.range(100).withColumn("v", F.lit("a"))))
    assert target.fetch(target.points()).count() == 100


def changed(rows):
    value = F.when(F.col("id") == 7, "z").otherwise(F.col("v"))
    return rows.where("id <> 3").withColumn("v", value).unionByName(spark_row(rows))


def spark_row(rows):
    return rows.limit(1).select(F.lit(9000).cast("bigint").alias("id"), F.lit("new").alias("v"))


@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_reconciling_by_buckets_equals_by_id(spark, buckets):
    rows = spark.range(300).withColumn("v", F.lit("a"))
    source, target = points(rows), points(changed(rows))
    expected = {tuple(r) for r in verify.reconcile_report(source, target).collect()}
    assert {tuple(r) for r in verify.reconcile_by_buckets(source, target, buckets).collect()} == expected
    assert {tuple(r) for r in verify.reconcile_by_buckets(source, source, buckets).collect()} == {("match", 300)}


def test_reconciling_nothing_and_repeats(spark):
    rows = spark.range(20).withColumn("v", F.lit("a"))
    empty = points(rows.limit(0))
    assert verify.reconcile_by_buckets(empty, empty).count() == 0
    assert {tuple(r) for r in verify.reconcile_by_buckets(points(rows), empty).collect()} == {("missing", 20)}
    twice = points(rows.unionByName(rows.where("id = 1")))
    assert {tuple(r) for r in verify.reconcile_by_buckets(twice, points(rows), 64).collect()} == {("match", 19), ("duplicate", 1)}


def test_equal_copies_move_no_ids(spark):
    sums = verify.bucket_sums(points(spark.range(10).withColumn("v", F.lit("a"))), 16)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("partial_sum") > plan.index("Exchange")
