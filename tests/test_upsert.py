import random

import pytest
from pyspark.sql import functions as F

from vecflow.operators.upsert import keep_last, upsert


def test_upsert_equals_a_dictionary(spark):
    rng = random.Random(3)
    target = {i: ("t", 0) for i in range(50)}
    batch = [(rng.randrange(80), f"b{n}", n) for n in range(200)]
    expected = dict(target)
    for key, value, seq in batch:
        expected[key] = (value, seq)
    left = spark.createDataFrame([(k, v, s) for k, (v, s) in target.items()], "id int, v string, seq int")
    right = spark.createDataFrame(batch, "id int, v string, seq int").repartition(7)
    once = upsert(left, right, "id", "seq")
    twice = upsert(once, right, "id", "seq")
    for result in (once, twice):
        assert {r["id"]: (r["v"], r["seq"]) for r in result.collect()} == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq")
    )
    last = keep_last(rows, "k", "seq")
    plan = last._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # printed top down
    assert last.count() == 200_001
    assert last.where("k = -1").first()["seq"] == 299_997


def test_empty_sides(spark):
    rows = spark.createDataFrame([(1, "a", 1)], "id int, v string, seq int")
    assert upsert(rows.limit(0), rows, "id", "seq").count() == 1
    assert upsert(rows, rows.limit(0), "id", "seq").count() == 1


@pytest.mark.parametrize("keys", [["a", "b"]])
def test_composite_keys(spark, keys):
    rows = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (1, 1, 2)], "a int, b int, seq int")
    assert {tuple(r) for r in keep_last(rows, keys, "seq").collect()} == {(1, 2, 1), (1, 1, 2)}
