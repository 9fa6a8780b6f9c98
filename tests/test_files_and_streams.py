import os
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecflow.operators.collection import StoredCollection
from vecflow.plans import ranges
from vecflow.queries.source_queries import write_flat_files
from vecflow.schema import POINT_COLUMNS
from vecflow.scratch import materialize, scratch_root
from vecflow.sources.collection import fetch_by_ids, scan_points, select_partitions
from vecflow.sources.flat import from_flat_vectors, scan_flat_vectors
from vecflow.sources.paged import paged_source
from vecflow.sources.relational import from_table
from vecflow.streaming.incremental import incremental_upsert, read_new_files

# -- flat vectors --------------------------------------------------------------


def flat_file(path, vectors):
    path.write_bytes(b"".join(struct.pack(f"<{len(v)}f", *v) for v in vectors))


def test_positions_run_across_files_and_splits(spark, tmp_path):
    folder = tmp_path / "flat"
    folder.mkdir()
    flat_file(folder / "part-0.f32", [[i, i + 0.5] for i in range(10)])
    flat_file(folder / "part-1.f32", [[i, i + 0.5] for i in range(10, 13)])
    flat_file(folder / "part-2.f32", [])
    (folder / "_SUCCESS").write_bytes(b"")
    rows = scan_flat_vectors(spark, str(folder), 2, split_bytes=24)
    assert rows.rdd.getNumPartitions() == 5
    assert {r["position"]: r["vector"] for r in rows.collect()} == {i: [i, i + 0.5] for i in range(13)}


def test_ids_from_a_map_or_the_position(spark, tmp_path):
    flat_file(tmp_path / "v.f32", [[1.0], [2.0]])
    path = str(tmp_path / "v.f32")
    points = from_flat_vectors(spark, path, 1)
    assert {int(r["id"]["num"]): r["dense"] for r in points.collect()} == {0: {"": [1.0]}, 1: {"": [2.0]}}
    id_map = spark.createDataFrame([(0, 70), (1, 80)], "position bigint, id bigint")
    assert {int(r["id"]["num"]) for r in from_flat_vectors(spark, path, 1, id_map).collect()} == {70, 80}


def test_a_file_with_half_a_vector_is_refused(spark, tmp_path):
    flat_file(tmp_path / "v.f32", [[1.0], [2.0], [3.0]])
    with pytest.raises(Exception, match="whole number"):
        scan_flat_vectors(spark, str(tmp_path / "v.f32"), 2).collect()
    with pytest.raises(ValueError):
        scan_flat_vectors(spark, str(tmp_path), 0)


def test_exported_vectors_come_back(spark, tmp_path):
    rows = spark.range(100).select("id", F.array(F.col("id").cast("float"), F.lit(0.25).cast("float")).alias("v"))
    write_flat_files(rows.orderBy(F.desc("id")), "id", "v", str(tmp_path / "out"))
    got = {r["position"]: r["vector"] for r in scan_flat_vectors(spark, str(tmp_path / "out"), 2).collect()}
    assert got == {i: [float(i), 0.25] for i in range(100)}


# -- paged sources -------------------------------------------------------------


@pytest.mark.parametrize("batch_size", [1, 7, 1000])
def test_every_record_is_paged_once(spark, batch_size):
    keys = list(range(0, 60, 2))

    def fetch(start, end, limit):
        wanted = [k for k in keys if (start is None or k > start) and (end is None or k <= end)]
        return pa.table({"k": pa.array(wanted[:limit], pa.int64())})

    sample = spark.createDataFrame([(10,), (11,), (40,)], "k bigint")
    plan = ranges.plan_rows(ranges.ranges_all_samples(sample, "k", "s"), "bigint")
    rows = paged_source(spark, fetch, plan, "k", "k bigint", batch_size)
    assert rows.rdd.getNumPartitions() == 4
    assert sorted(r["k"] for r in rows.collect()) == keys


def test_page_size_must_be_positive(spark):
    with pytest.raises(ValueError, match="greater than 0"):
        paged_source(spark, lambda *_: None, [], "k", "k bigint", 0)


# -- collections on disk -------------------------------------------------------


def test_stored_points_read_back(spark, folder, tmp_path):
    points = from_table(spark.read.parquet(f"{folder}/embeddings.parquet"), "vec_id")
    points.write.parquet(str(tmp_path / "points"))
    stored = scan_points(spark, str(tmp_path / "points"))
    assert stored.columns == POINT_COLUMNS and stored.count() == points.count()
    with pytest.raises(ValueError, match="lacks point columns"):
        scan_points(spark, f"{folder}/embeddings.parquet")


def test_partition_choice(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    assert select_partitions(rows, "p", ["a", "x"]).count() == 1
    assert select_partitions(rows, "p", []).count() == 3


def test_fetching_ids_ignores_repeats_and_strangers(spark):
    store = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    wanted = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    assert [tuple(r) for r in fetch_by_ids(wanted, store).collect()] == [(1, "a")]


def test_scratch_folder_follows_the_session(spark, tmp_path):
    named = FakeSession({"spark.checkpoint.dir": f"{tmp_path}/shared/"}, "yarn")
    assert scratch_root(named) == f"{tmp_path}/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession({}, "yarn"))
    assert scratch_root(spark) == scratch_root(spark)
    kept = materialize(spark.range(3), "t")
    assert kept.count() == 3 and "FileScan" in kept._jdf.queryExecution().executedPlan().toString()


class FakeSession:
    """Just enough of a session to ask for settings."""

    def __init__(self, settings, master):
        self.conf = self
        self.settings, self.master = settings, master
        self.sparkContext = self

    def get(self, key, default):
        return self.settings.get(key, default)


# -- streams -------------------------------------------------------------------


def test_a_second_run_reads_only_what_is_new(spark, folder, tmp_path):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    target = StoredCollection(spark, str(tmp_path / "target"), buckets=2)

    def run():
        stream = read_new_files(spark, inbox, orders.schema, files_per_batch=1)
        query = incremental_upsert(stream, target, checkpoint, lambda r: from_table(r, "o_orderkey"))
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    first = orders.where("o_orderkey % 3 = 0")
    first.repartition(2).write.parquet(inbox)
    assert sum(run()) == first.count() and run() == []
    changed = orders.withColumn("o_totalprice", F.lit(1.0))
    changed.coalesce(1).write.mode("append").parquet(inbox)
    assert run() == [orders.count()]
    price = F.variant_get("payload", "$.o_totalprice", "double")
    summary = target.points().agg(F.count("*"), F.sum(price)).first()
    assert tuple(summary) == (orders.count(), float(orders.count()))


def test_paced_batches_and_a_fresh_start(spark, folder, tmp_path):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    inbox = str(tmp_path / "in")
    orders.repartition(2).write.parquet(inbox)
    target = StoredCollection(spark, str(tmp_path / "target"), buckets=2)
    for checkpoint in ("first", "second"):
        stream = read_new_files(spark, inbox, orders.schema, files_per_batch=1)
        query = incremental_upsert(
            stream, target, str(tmp_path / checkpoint), lambda r: from_table(r, "o_orderkey"), interval="1 second"
        )
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        assert target.points().count() == orders.count()


@pytest.mark.parametrize("sizes", [(4000, 10), (10, 4000)])
def test_of_two_files_in_one_batch_the_later_wins(spark, tmp_path, sizes):
    inbox, target = tmp_path / "in", StoredCollection(spark, str(tmp_path / "target"), buckets=2)
    for version, size in enumerate(sizes):
        rows = spark.range(size).select("id", F.lit(version).alias("version"))
        rows.coalesce(1).write.mode("append").parquet(str(inbox))
        for file in inbox.glob("*.parquet"):  # a second between the two files' times
            if version == 0:
                os.utime(file, (1_700_000_000, 1_700_000_000))
    stream = read_new_files(spark, str(inbox), "id bigint, version int")
    incremental_upsert(stream, target, str(tmp_path / "cp"), lambda r: from_table(r, "id")).awaitTermination()
    version = F.variant_get("payload", "$.version", "int")
    late = target.points().where(version == 1).count()
    assert (target.points().count(), late) == (4000, sizes[1])


def test_files_per_batch_must_be_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        read_new_files(spark, str(tmp_path), "a int", files_per_batch=0)
