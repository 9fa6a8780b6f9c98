"""Checks before a copy, the copy, and what is left after it."""

import pytest
from pyspark.sql import functions as F

from vecflow.functions import ids
from vecflow.operators.catalog import check_dimensions
from vecflow.operators.collection import StoredCollection
from vecflow.operators.transfer import copy_collection
from vecflow.plans import ranges
from vecflow.plans.progress import ProgressTable
from vecflow.schema import COLLECTION, to_points
from vecflow.sources.relational import from_table


def catalog_row(spark, vectors, sparse_names=(), method="auto"):
    return spark.createDataFrame([("c", vectors, list(sparse_names), {}, method)], COLLECTION)


def test_all_kinds_of_vectors_are_checked(spark):
    points = to_points(
        spark.range(4),
        id=ids.numeric_id(F.col("id")),
        dense=F.expr("map('d', array(1f, 2f), 'other', array(1f))"),
        multi=F.expr("map('m', array(array(1f, 2f), array(1f, 2f, 3f)), 'empty', array())"),
        sparse=F.expr(
            "map('s', named_struct('indices', array(1L), 'values', array(1f)), 'd2', "
            "named_struct('indices', array(1L), 'values', array(1f)))"
        ),
    ).withColumn("name", F.lit("c"))
    spec = catalog_row(spark, {"d": (2, "dot"), "m": (2, "dot"), "d2": (2, "dot")}, ["s"])
    wrong = {(r["vector"], r["found_size"], r["declared_size"]): r["points"] for r in check_dimensions(points, spec).collect()}
    assert wrong == {("other", 1, None): 4, ("m", 3, 2): 4, ("d2", None, None): 4}


class Copy:
    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, tmp_path
        vector = F.array(*[F.lit(float(i)).cast("float") for i in range(3)])
        self.rows = spark.range(50).select("id", vector.alias("v"))
        plan = ranges.plan_ranges(self.rows, "id", 1, "s", "p", seed="x")
        self.plan = ranges.save_plan(plan, str(tmp_path / "plan"))
        self.progress = ProgressTable(spark, str(tmp_path / "progress"))
        self.target = StoredCollection(spark, str(tmp_path / "target"), buckets=2)

    def run(self, spec, **options):
        return copy_collection(
            self.rows, "id", self.plan, lambda r: from_table(r, "id"), self.target, self.progress, spec, **options
        )


def test_a_copy_ends_with_equal_counts_and_no_progress(spark, tmp_path):
    copy = Copy(spark, tmp_path)
    assert copy.run(catalog_row(spark, {"v": (3, "dot")}), ranges_per_job=6) == (50, 50)
    assert copy.progress.load().count() == 0


def test_progress_stays_while_counts_differ(spark, tmp_path):
    copy = Copy(spark, tmp_path)
    copy.target.upsert(from_table(copy.rows.withColumn("id", F.col("id") + 1000), "id"))
    assert copy.run(catalog_row(spark, {"v": (3, "dot")})) == (50, 100)
    assert copy.progress.load().count() > 0


def test_a_wrong_size_or_sharding_stops_before_any_write(spark, tmp_path):
    copy = Copy(spark, tmp_path)
    with pytest.raises(ValueError, match="has size 3, the target's is 4"):
        copy.run(catalog_row(spark, {"v": (4, "dot")}))
    with pytest.raises(Exception, match="its sharding is not custom"):
        copy.run(catalog_row(spark, {"v": (3, "dot")}), routed=True)
    with pytest.raises(ValueError, match="does not exist"):
        copy.run(catalog_row(spark, {}).limit(0))
    assert copy.target.points().count() == 0 and copy.progress.load().count() == 0
