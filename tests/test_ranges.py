import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from vecflow.plans import ranges


def keys_of(df):
    return [r[0] for r in df.collect()]


def plan_of(df):
    rows = df.orderBy("range_id").collect()
    return [(r["range_id"], r["start_key"], r["end_key"]) for r in rows]


@pytest.mark.parametrize("n", [0, 1, 7, 400, 1000, 5000])
def test_sample_is_exact_sorted_and_repeatable(spark, n):
    rows = spark.range(1000).repartition(5)
    sample = keys_of(ranges.sample_keys(rows, "id", n, "s"))
    assert len(sample) == min(n, 1000) == len(set(sample))
    assert sample == sorted(sample)
    assert sample == keys_of(ranges.sample_keys(rows.repartition(2), "id", n, "s"))
    if n == 400:
        assert sample != keys_of(ranges.sample_keys(rows, "id", n, "other"))


def test_sample_is_spread_evenly(spark):
    sample = keys_of(ranges.sample_keys(spark.range(100_000), "id", 2000, "s"))
    halves = sum(k < 50_000 for k in sample)
    assert 850 < halves < 1150


def test_ranges_from_all_samples(spark):
    sample = spark.createDataFrame([(30,), (9,), (100,)], "k int")
    assert plan_of(ranges.ranges_all_samples(sample, "k", "s")) == [
        (0, None, "9"), (1, "9", "30"), (2, "30", "100"), (3, "100", None),
    ]
    assert plan_of(ranges.ranges_all_samples(sample.limit(0), "k", "s")) == [(0, None, None)]


@pytest.mark.parametrize(
    "keys,workers,expected",
    [
        ([], 4, [(0, None, None)]),
        ([5], 1, [(0, None, None)]),
        ([5], 4, [(0, None, "5"), (1, "5", None)]),
        ([1, 2, 3], 4, [(0, None, "1"), (1, "1", "2"), (2, "2", "3"), (3, "3", None)]),
        (list(range(10)), 4, [(0, None, "2"), (1, "2", "5"), (2, "5", "7"), (3, "7", None)]),
    ],
)
def test_even_ranges(spark, keys, workers, expected):
    sample = spark.createDataFrame([(k,) for k in keys], "k int")
    assert plan_of(ranges.ranges_even(sample, "k", workers, "s")) == expected


def brute_range(bounds, key):
    return sum(b < key for b in bounds)


@pytest.mark.parametrize("m", [0, 1, 2, 3, 7, 8, 9, 100])
def test_every_key_meets_its_range(spark, m):
    bounds = [3 * i + 1 for i in range(m)]
    sample = spark.createDataFrame([(b,) for b in bounds], "k bigint")
    plan = ranges.ranges_all_samples(sample, "k", "s")
    assigned = ranges.assign_range(spark.range(-2, 3 * m + 5), "id", plan).collect()
    assert all(r["range_id"] == brute_range(bounds, r["id"]) for r in assigned)
    for row in ranges.plan_rows(plan, "bigint"):
        inside = spark.range(-2, 3 * m + 5).where(
            ranges.in_range(F.col("id"), row["start_key"], row["end_key"])
        )
        assert {r["id"] for r in inside.collect()} == {
            r["id"] for r in assigned if r["range_id"] == row["range_id"]
        }


def test_assignment_needs_no_join(spark):
    plan = ranges.ranges_all_samples(spark.range(0, 90, 3).toDF("k"), "k", "s")
    assigned = ranges.assign_range(spark.range(100), "id", plan)
    physical = assigned._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in physical and "Exchange" not in physical


def test_text_keys_compare_as_text(spark):
    rows = spark.createDataFrame([(k,) for k in ["10", "9", "a'b", 'q"', "é"]], "k string")
    plan = ranges.ranges_all_samples(rows.where("k in ('9', 'a''b')"), "k", "s")
    got = {r["k"]: r["range_id"] for r in ranges.assign_range(rows, "k", plan).collect()}
    assert got == {"10": 0, "9": 0, "a'b": 1, 'q"': 2, "é": 2}
    assert ranges.plan_predicates(ranges.plan_rows(plan, "string"), "k") == [
        """"k" <= '9' OR "k" IS NULL""", """"k" > '9' AND "k" <= 'a''b'""", """"k" > 'a''b'""",
    ]
    with pytest.raises(TypeError, match="portable"):
        ranges.plan_predicates([Row(start_key=None, end_key=b"x")], "k")


def test_range_bounds_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    rows = orders.where(ranges.in_range(F.col("o_orderkey"), 10, 20))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan and "LessThanOrEqual(o_orderkey,20)" in plan


def test_a_stored_plan_stays_the_same(spark, tmp_path):
    path = str(tmp_path / "plan")
    first = ranges.save_plan(
        ranges.plan_ranges(spark.range(1000), "id", 4, "s", "p1", seed="a"), path
    )
    assert plan_of(first) == plan_of(ranges.load_plan(first, path))
    with pytest.raises(Exception):
        ranges.save_plan(first.limit(1), path)


def test_batches_follow_key_order(spark):
    rows = spark.range(25).withColumn("range_id", (F.col("id") >= 12).cast("int"))
    got = [(r["id"], r["batch"]) for r in ranges.batch_number(rows, "id", 5).collect()]
    assert got == [(i, (i if i < 12 else i - 12) // 5) for i in range(25)]
    for n in (0, -1):
        with pytest.raises(ValueError, match="greater than 0"):
            ranges.batch_number(rows, "id", n)


def test_pages(spark):
    rows = spark.range(20).repartition(4)
    assert keys_of(ranges.offset_page(rows, "id", 5, 3)) == [5, 6, 7]
    assert keys_of(ranges.keyset_page(rows, "id", None, 2)) == [0, 1]
    assert keys_of(ranges.keyset_page(rows, "id", 17, 5)) == [18, 19]


def test_a_hot_range_is_laid_out_over_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        sample = spark.createDataFrame([(5,), (100_000,)], "k bigint")
        laid_out = ranges.range_partition(rows, "k", ranges.ranges_all_samples(sample, "k", "s"))
        laid_out.write.parquet(str(tmp_path / "out"))
        stored = spark.read.parquet(str(tmp_path / "out"))
        files = stored.select("range_id", F.input_file_name().alias("file")).distinct()
        assert files.where("range_id = 1").count() > 1
        assert stored.count() == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_a_key_in_most_rows_is_sampled_once(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    keys = keys_of_column(ranges.sample_keys(rows, "k", 40, seed="s"))
    assert len(keys) == len(set(keys)) == 40
    assert keys_of_column(ranges.sample_keys(rows.where("k = 7"), "k", 40)) == [7]


def keys_of_column(df):
    return [r[0] for r in df.collect()]
