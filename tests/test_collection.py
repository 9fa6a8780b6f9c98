import pytest
from pyspark.sql import functions as F

from vecflow.functions import ids
from vecflow.operators.collection import StoredCollection
from vecflow.schema import ID, to_points


def points(spark, start, end, mark):
    return to_points(
        spark.range(start, end),
        id=ids.numeric_id(F.col("id")),
        dense=F.create_map(F.lit("v"), F.array(F.col("id").cast("float"))),
        payload=F.to_variant_object(F.struct(F.lit(mark).alias("mark"))),
    )


def state(collection):
    mark = F.variant_get("payload", "$.mark", "string")
    rows = collection.points().select(F.col("id.num").cast("int"), mark, "dense").collect()
    assert all(r[2] == {"v": [float(r[0])]} for r in rows)
    found = {r[0]: r[1] for r in rows}
    assert len(found) == len(rows)
    return found


def expect(*parts):
    out = {}
    for start, end, mark in parts:
        out.update({i: mark for i in range(start, end)})
    return out


def test_inserts_replaces_and_repeats(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=4)
    assert state(target) == {}
    assert target.upsert(points(spark, 0, 100, "a")) == 100
    assert target.upsert(points(spark, 100, 150, "b")) == 50
    assert target.upsert(points(spark, 90, 110, "c")) == 20
    expected = expect((0, 90, "a"), (90, 110, "c"), (110, 150, "b"))
    assert state(target) == expected
    target.upsert(points(spark, 90, 110, "c"))
    assert state(target) == expected
    assert state(StoredCollection(spark, str(tmp_path / "c"), buckets=99)) == expected


def stored_rows(target):
    return {f["name"]: target._read([f]).count() for f in target._folders()}


def test_an_upsert_writes_its_own_rows_only(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=64)
    target.upsert(points(spark, 0, 2000, "a"))
    first = stored_rows(target)
    target.upsert(points(spark, 0, 2000, "b").where("id.num % 20 = 7"))
    assert sorted(stored_rows(target).values()) == [100, 2000]
    assert {n: c for n, c in stored_rows(target).items() if n in first} == first
    replaced = {i: "b" if i % 20 == 7 else "a" for i in range(2000)}
    assert state(target) == replaced
    target.compact()
    assert state(target) == replaced and sum(stored_rows(target).values()) == 2000


def test_rows_cross_the_network_once(spark, tmp_path, monkeypatch):
    plans, write = [], StoredCollection._write

    def spy(self, rows, number):
        plans.append(rows.hint("rebalance", "bucket")._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, number)

    monkeypatch.setattr(StoredCollection, "_write", spy)
    StoredCollection(spark, str(tmp_path / "c"), buckets=4).upsert(points(spark, 0, 50, "a"))
    assert plans[0].count("Exchange") == 1 and "Sort" not in plans[0] and "Window" not in plans[0]


def test_the_later_of_repeated_ids_stays(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    both = points(spark, 0, 5, "late").withColumn("seq", F.lit(2)).unionByName(
        points(spark, 0, 5, "early").withColumn("seq", F.lit(1))
    )
    assert target.upsert(both, seq="seq") == 5
    assert set(state(target).values()) == {"late"}
    with pytest.raises(ValueError, match="all without"):
        target.upsert(points(spark, 0, 5, "x"))
    unsequenced = StoredCollection(spark, str(tmp_path / "d"), buckets=2)
    assert unsequenced.upsert(points(spark, 0, 5, "x").union(points(spark, 0, 5, "y"))) == 5
    assert set(state(unsequenced).values()) == {"y"}


def test_an_older_version_in_a_later_batch_does_not_win(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    for mark, seq in [("nine", 9), ("three", 3), ("null", None)]:
        target.upsert(points(spark, 0, 5, mark).withColumn("seq", F.lit(seq).cast("bigint")), seq="seq")
    assert set(state(target).values()) == {"nine"}
    target.compact()
    target.upsert(points(spark, 0, 2, "eight").withColumn("seq", F.lit(8)), seq="seq")
    assert set(state(target).values()) == {"nine"}
    target.upsert(points(spark, 0, 5, "again").withColumn("seq", F.lit(9)), seq="seq")
    assert set(state(target).values()) == {"again"}
    with pytest.raises(TypeError):
        target.upsert(points(spark, 0, 5, "x").withColumn("seq", F.lit(1.5)), seq="seq")


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    target.upsert(points(spark, 0, 10, "a"))

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(StoredCollection, "_commit", crash)
        with pytest.raises(RuntimeError):
            target.upsert(points(spark, 5, 15, "b"))
    assert state(StoredCollection(spark, target.path)) == expect((0, 10, "a"))
    target.upsert(points(spark, 5, 15, "b"))
    assert state(target) == expect((0, 5, "a"), (5, 15, "b"))


def test_two_writers_cannot_make_the_same_commit(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    target.upsert(points(spark, 0, 10, "a"))
    with pytest.raises(RuntimeError, match="another writer"):
        target._commit(1, [], False)


def test_a_refused_writer_leaves_committed_points_alone(spark, tmp_path, monkeypatch):
    slow = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    number = slow._next_number()
    StoredCollection(spark, slow.path, buckets=2).upsert(points(spark, 0, 10, "b"))
    monkeypatch.setattr(slow, "_next_number", lambda: number)
    with pytest.raises(RuntimeError, match="another writer"):
        slow.upsert(points(spark, 0, 3, "a"))
    assert state(StoredCollection(spark, slow.path)) == expect((0, 10, "b"))


@pytest.mark.parametrize("missing", ["NULL", "named_struct('num', NULL, 'uuid', NULL)"])
def test_missing_ids_are_refused(spark, tmp_path, missing):
    target = StoredCollection(spark, str(tmp_path / "c"))
    nameless = points(spark, 0, 3, "a").withColumn("id", F.expr(missing).cast(ID))
    with pytest.raises(Exception, match="id is missing"):
        target.upsert(nameless)


def test_an_empty_batch_makes_no_commit(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"))
    assert target.upsert(points(spark, 0, 0, "a")) == 0
    assert target._commit_numbers() == []


def test_folders_are_merged_and_stale_ones_deleted(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=2)
    for i in range(4):
        target.upsert(points(spark, 10 * i, 10 * i + 10, f"m{i}"))
    expected = expect(*[(10 * i, 10 * i + 10, f"m{i}") for i in range(4)])
    first = target._folders()[0]["name"]
    target.compact(max_folders=4)
    assert len(target._folders()) == 4
    target.compact()
    assert len(target._folders()) == 1 and state(target) == expected
    assert target.vacuum(keep_commits=100) == []
    deleted = target.vacuum(keep_commits=1)
    assert f"commit={first}" in deleted and state(target) == expected
    assert not (tmp_path / "c" / f"commit={first}").exists()
    with pytest.raises(ValueError):
        target.vacuum(0)


def test_some_buckets_of_a_folder_can_be_merged(spark, tmp_path):
    target = StoredCollection(spark, str(tmp_path / "c"), buckets=8)
    target.upsert(points(spark, 0, 100, "a"))
    target.upsert(points(spark, 7, 8, "c"))
    target.compact()
    assert [f["whole"] for f in target._folders()] == [False, True]
    assert state(target) == expect((0, 100, "a"), (7, 8, "c"))
