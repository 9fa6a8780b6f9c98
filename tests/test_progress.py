import time
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids
from vecflow.operators.collection import StoredCollection
from vecflow.operators.transfer import transfer, wanted
from vecflow.operators.verify import reconcile_report
from vecflow.plans import progress as tracking
from vecflow.plans import ranges
from vecflow.schema import PROGRESS, to_points
from vecflow.sources.relational import from_table


def rows_of(df):
    return {(r["source_key"], r["plan_id"], r["range_id"]): (r["last_key"], r["processed"]) for r in df.collect()}


def report(spark, *rows):
    return spark.createDataFrame(rows, "source_key string, plan_id string, range_id int, last_key string, processed bigint")


def test_latest_row_per_range_counts(spark, tmp_path):
    table = tracking.ProgressTable(spark, str(tmp_path / "p"))
    assert rows_of(table.load()) == {}
    table.store(report(spark, ("s", "p", 0, "10", 10), ("s", "p", 1, "20", 5)))
    table.store(report(spark, ("s", "p", 0, "15", 15), ("t", "p", 0, "1", 1)))
    assert rows_of(table.load()) == {
        ("s", "p", 0): ("15", 15), ("s", "p", 1): ("20", 5), ("t", "p", 0): ("1", 1)
    }
    assert rows_of(table.load(restart=True)) == {}
    table.clear("s", "p")
    assert rows_of(table.load()) == {("t", "p", 0): ("1", 1)}
    table.store(report(spark, ("s", "p", 0, "3", 3)))
    assert rows_of(table.load())[("s", "p", 0)] == ("3", 3)


def test_a_row_without_key_or_count_means_from_the_beginning(spark):
    at = datetime(2024, 1, 1)
    history = spark.createDataFrame(
        [("s", "p", 0, None, 3, at), ("s", "p", 1, "7", None, at), ("s", "p", 2, "7", 1, at)], PROGRESS
    )
    assert rows_of(tracking.latest_progress(history)) == {("s", "p", 2): ("7", 1)}


def test_resuming_uses_only_the_same_plan(spark):
    sample = spark.createDataFrame([(10,)], "k int")
    plan = ranges.ranges_all_samples(sample, "k", "s", "p1")
    done = report(spark, ("s", "p1", 0, "4", 4), ("s", "p0", 1, "99", 9), ("t", "p1", 1, "99", 9))
    resumed = ranges.resume_ranges(plan, done).orderBy("range_id").collect()
    assert [(r["start_key"], r["end_key"], r["processed"]) for r in resumed] == [("4", "10", 4), ("10", None, 0)]


def test_totals_and_running_counts(spark):
    batches = spark.createDataFrame(
        [("s", 0, 0, 5), ("s", 0, 1, 2), ("s", 1, 0, 5), ("s", 2, 0, 1), ("t", 0, 0, 4)],
        "source_key string, range_id int, batch bigint, points bigint",
    )
    running = tracking.cumulative_progress(batches).collect()
    assert {(r["source_key"], r["range_id"], r["batch"]): r["processed"] for r in running} == {
        ("s", 0, 0): 5, ("s", 0, 1): 7, ("s", 1, 0): 12, ("s", 2, 0): 13, ("t", 0, 0): 4
    }


class Setup:
    def __init__(self, spark, folder, tmp_path):
        self.spark, self.path = spark, tmp_path
        self.orders = spark.read.parquet(f"{folder}/orders.parquet")
        plan = ranges.plan_ranges(self.orders, "o_orderkey", 1, "orders", "p1", seed="x")
        self.plan = ranges.save_plan(plan, str(tmp_path / "plan"))
        self.progress = tracking.ProgressTable(spark, str(tmp_path / "progress"))

    def run(self, target, source=None, **options):
        source = self.orders if source is None else source
        return transfer(source, "o_orderkey", self.plan, lambda r: from_table(r, "o_orderkey"), target,
                        self.progress, ranges_per_job=4, **options)

    def target(self, name="target"):
        return StoredCollection(self.spark, str(self.path / name), buckets=4)

    def report(self, target):
        source = from_table(self.orders, "o_orderkey")
        return {r["status"]: r["points"] for r in reconcile_report(source, target.points()).collect()}


def test_resumed_copy_equals_one_in_a_single_run(spark, folder, tmp_path, monkeypatch):
    setup = Setup(spark, folder, tmp_path)
    target, total = setup.target(), setup.orders.count()
    upsert, calls = StoredCollection.upsert, []

    def fail_on_second_job(self, batch, seq=None):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return upsert(self, batch, seq)

    with monkeypatch.context() as patch:
        patch.setattr(StoredCollection, "upsert", fail_on_second_job)
        with pytest.raises(RuntimeError, match="lost"):
            setup.run(target)
    half = target.points().count()
    assert 0 < half < total
    assert setup.run(target) == total - half
    assert setup.report(target) == {"match": total}
    processed = tracking.total_processed(setup.progress.load()).first()["processed"]
    assert processed == total
    assert setup.run(target) == 0
    assert setup.run(target, restart=True) == total
    assert setup.report(target) == {"match": total}


def test_wanted_keys_of_half_copied_ranges(spark):
    starts, ends = [None, "13", "20", "38", "45"], ["10", "20", "30", "40"]
    plan = [{"range_id": i, "start_key": s, "end_key": e} for i, (s, e) in enumerate(zip(starts, [*ends, "55"]))]
    rows = spark.range(60).select("id").unionByName(spark.sql("SELECT CAST(NULL AS bigint) AS id"))
    keys = rows.where(wanted(F.col("id"), ends, [plan[i] for i in (0, 1, 3, 4)], T.LongType()))
    expected = [*range(0, 11), *range(14, 21), 39, 40, *range(46, 56)]
    assert sorted(r["id"] for r in keys.collect()) == expected


def test_the_outer_bounds_of_a_job_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    job = [{"range_id": 1, "start_key": "10", "end_key": "20"}]
    rows = orders.where(wanted(F.col("o_orderkey"), ["10", "20"], job, T.LongType()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan and "LessThanOrEqual(o_orderkey,20)" in plan


KEYS = {
    "timestamp": "timestamp_micros(id * 1800000123 + 1698500000000000)",
    "binary": "unhex(lpad(hex(id * 977), 8, '0'))",
    "double": "id / 7",
    "decimal": "CAST(id / 8 AS decimal(20,4))",
    "string": "concat('ké', CAST(id AS string))",
}


@pytest.fixture
def new_york(monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


@pytest.mark.parametrize("kind", KEYS)
def test_many_half_done_ranges_lose_nothing_whatever_the_key(spark, tmp_path, new_york, kind):
    source = spark.range(400).select(F.expr(KEYS[kind]).alias("k"), "id")
    plan = ranges.save_plan(ranges.plan_ranges(source, "k", 4, "s", "p"), f"{tmp_path}/plan")
    assert ranges.assign_range(source, "k", plan).select("range_id").distinct().count() == 41
    progress, target = tracking.ProgressTable(spark, f"{tmp_path}/progress"), StoredCollection(spark, f"{tmp_path}/c", 2)

    def copy(rows):
        return transfer(rows, "k", plan, lambda r: points_of(r), target, progress)

    def points_of(rows):
        return to_points(rows, id=ids.numeric_id(F.col("id")), payload=F.to_variant_object(F.struct("id")))

    # The first half of each range is there at first, the rest comes later.
    in_order = Window.partitionBy("range_id").orderBy("k")
    half = ranges.assign_range(source, "k", plan).withColumn("h", F.ntile(2).over(in_order)).where("h = 1")
    early = half.select("k", "id").count()
    assert copy(half.select("k", "id")) == early
    assert copy(source) == 400 - early
    assert target.points().count() == 400 and copy(source) == 0


def test_a_key_that_comes_during_the_copy_is_copied_next_time(spark, tmp_path):
    path, target = f"{tmp_path}/source", StoredCollection(spark, f"{tmp_path}/c", 2)
    spark.range(100).toDF("k").write.parquet(path)
    plan = ranges.save_plan(ranges.plan_ranges(spark.read.parquet(path), "k", 1, "s", "p"), f"{tmp_path}/plan")
    progress = tracking.ProgressTable(spark, f"{tmp_path}/progress")

    def copy():
        return transfer(spark.read.parquet(path), "k", plan, lambda r: from_table(r, "k"), target, progress)

    upsert = target.upsert

    def late(batch, seq=None):
        written = upsert(batch, seq)
        spark.range(100, 105).toDF("k").write.mode("append").parquet(path)
        return written

    target.upsert = late
    assert copy() == 100
    target.upsert = upsert
    assert copy() == 5 and target.points().count() == 105


def test_an_interrupted_restart_starts_again(spark, folder, tmp_path, monkeypatch):
    setup = Setup(spark, folder, tmp_path)
    setup.run(setup.target())
    fresh, upsert, calls = setup.target("fresh"), StoredCollection.upsert, []

    def fail_on_second_job(self, batch, seq=None):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return upsert(self, batch, seq)

    with monkeypatch.context() as patch:
        patch.setattr(StoredCollection, "upsert", fail_on_second_job)
        with pytest.raises(RuntimeError):
            setup.run(fresh, restart=True)
    setup.run(fresh)
    assert setup.report(fresh) == {"match": setup.orders.count()}


def test_data_committed_without_its_progress_is_applied_once(spark, folder, tmp_path, monkeypatch):
    setup = Setup(spark, folder, tmp_path)
    target = setup.target()

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tracking.ProgressTable, "store", crash)
        with pytest.raises(RuntimeError):
            setup.run(target)
    setup.run(target)
    assert setup.report(target) == {"match": setup.orders.count()}


def test_empty_source(spark, folder, tmp_path):
    setup = Setup(spark, folder, tmp_path)
    empty = setup.orders.limit(0)
    setup.plan = ranges.plan_ranges(empty, "o_orderkey", 4, "orders", "p2")
    assert setup.run(setup.target(), source=empty) == 0


@pytest.mark.parametrize("workers,even", [(1, False), (4, True), (4, False)])
def test_any_number_of_workers_gives_the_same_copy(spark, folder, tmp_path, workers, even):
    setup = Setup(spark, folder, tmp_path)
    setup.plan = ranges.plan_ranges(setup.orders, "o_orderkey", workers, "orders", f"w{workers}", even)
    target = setup.target()
    transfer(setup.orders, "o_orderkey", setup.plan, lambda r: from_table(r, "o_orderkey"), target,
             setup.progress, ranges_per_job=50)
    assert setup.report(target) == {"match": setup.orders.count()}


def test_new_records_resume_after_the_open_last_range(spark, folder, tmp_path):
    setup = Setup(spark, folder, tmp_path)
    target = setup.target()
    early = setup.orders.where("o_orderkey < 1000")
    setup.run(target, source=early)
    late = setup.orders.where("o_orderkey >= 1000").count()
    written = setup.run(target)
    assert written <= late + early.count() and setup.report(target)["match"] >= early.count()


@pytest.mark.parametrize("per_job", [None, 4])
def test_a_null_key_stops_the_copy_however_it_is_cut(spark, tmp_path, per_job):
    rows = spark.range(39).select(F.col("id").alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS bigint) AS k"))
    plan = ranges.save_plan(ranges.plan_ranges(rows.where("k IS NOT NULL"), "k", workers=4, source_key="s", plan_id="p"), f"{tmp_path}/plan")
    target = StoredCollection(spark, f"{tmp_path}/points")
    with pytest.raises(Exception, match="missing key"):
        transfer(rows, "k", plan, lambda r: from_table(r, "k"), target, tracking.ProgressTable(spark, f"{tmp_path}/progress"),
                 ranges_per_job=per_job)
