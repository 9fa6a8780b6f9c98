import json

import pytest
from pyspark.sql import functions as F

from vecflow.functions import ids
from vecflow.operators import catalog, routing, sink, verify
from vecflow.schema import SHARD_KEY, to_points

# -- sink ----------------------------------------------------------------------


def test_transient_failures_are_retried_with_growing_pauses():
    pauses, failures = [], ["Please retry", "RST_STREAM x", "connection error"]

    def send():
        if failures:
            raise RuntimeError(failures.pop(0))

    assert sink.send_with_retry(send, pauses.append) == 3
    assert pauses == pytest.approx([0.2, 0.4, 0.8])


def test_other_failures_stop_at_once():
    pauses, calls = [], []

    def send():
        calls.append(1)
        raise RuntimeError("bad request")

    with pytest.raises(RuntimeError, match="bad request"):
        sink.send_with_retry(send, pauses.append)
    assert len(calls) == 1 and pauses == []


def test_retries_end_after_five_attempts_without_a_last_pause():
    pauses, calls = [], []

    def send():
        calls.append(1)
        raise RuntimeError("ResourceExhausted")

    with pytest.raises(RuntimeError):
        sink.send_with_retry(send, pauses.append)
    assert len(calls) == 5 and pauses == pytest.approx([0.2, 0.4, 0.8, 1.6])


def test_points_reach_the_client_in_batches(spark, tmp_path):
    folder = str(tmp_path)

    class Client:
        def upsert(self, rows):
            import uuid

            with open(f"{folder}/{uuid.uuid4()}.json", "w") as out:
                json.dump([[r["id"], r["payload"], dict(r["dense"])] for r in rows], out)

    points = to_points(
        spark.range(0, 103, 1, 2),
        id=ids.numeric_id(F.col("id")),
        dense=F.create_map(F.lit(""), F.array(F.lit(1.5).cast("float"))),
        payload=F.to_variant_object(F.struct("id")),
    )
    total = sink.write_batches(points, Client, batch_size=10).first()
    assert (total["points"], total["batches"], total["retries"]) == (103, 12, 0)
    sent = [json.loads(f.read_text()) for f in tmp_path.glob("*.json")]
    assert max(len(b) for b in sent) == 10
    got = sorted(r[0] for batch in sent for r in batch)
    assert got == list(range(103))
    assert sent[0][0][1] == f'{{"id":{sent[0][0][0]}}}' and sent[0][0][2] == {"": [1.5]}
    with pytest.raises(ValueError, match="greater than 0"):
        sink.write_batches(points, Client, batch_size=0)


def test_batches_of_a_client_target_hold_one_shard(spark, tmp_path):
    folder = str(tmp_path)

    class Client:
        def create_shard_key(self, key):
            self.keys = {*getattr(self, "keys", ()), key}

        def upsert(self, rows):
            import uuid

            (key,) = {r["shard_key"] for r in rows}
            if key is not None and key not in self.keys:
                raise ValueError("unknown shard")
            with open(f"{folder}/{uuid.uuid4()}.json", "w") as out:
                json.dump([key, [r["id"] for r in rows]], out)

    shard = F.when(F.col("id") % 3 == 0, F.struct(F.lit("a").alias("keyword"), F.lit(None).alias("num"))).when(
        F.col("id") % 3 == 1, F.struct(F.lit(None).alias("keyword"), F.lit(7).alias("num"))
    )
    points = to_points(
        spark.range(0, 100, 1, 2), id=ids.numeric_id(F.col("id")),
        payload=F.to_variant_object(F.struct("id")), shard_key=shard.cast(SHARD_KEY),
    )
    target = sink.ClientTarget(spark, Client, str(tmp_path / "log"), batch_size=10)
    assert target.upsert(points) == 100 and target.upsert(points.limit(0)) == 0
    counts = {(r["keyword"], r["number"] and int(r["number"])): r["points"] for r in target.sent().collect()}
    assert counts == {("a", None): 34, (None, 7): 33, (None, None): 33}
    sent = [json.loads(f.read_text()) for f in tmp_path.glob("*.json")]
    assert sorted(i for _, batch in sent for i in batch) == list(range(100))


# -- routing -------------------------------------------------------------------


def routable(spark, *payloads):
    rows = spark.createDataFrame(list(enumerate(payloads)), "id int, p string")
    return to_points(rows, id=ids.numeric_id(F.col("id")), payload=F.parse_json("p"))


def test_usable_shard_values(spark):
    points = routable(spark, '{"a b":"x"}', '{"a b":0}', '{"a b":9223372036854775807}')
    keys = [tuple(r[0]) for r in routing.route(points, field="a b").orderBy("id.num").select("shard_key").collect()]
    assert [(k, n and int(n) if n is not None else None) for k, n in keys] == [
        ("x", None), (None, 0), (None, 9223372036854775807)
    ]


@pytest.mark.parametrize(
    "payload,reason",
    [
        ("{}", "is missing"),
        ('{"s":""}', "holds neither"),
        ('{"s":-1}', "holds neither"),
        ('{"s":1.5}', "holds neither"),
        ('{"s":1.0}', "holds neither"),
        ('{"s":true}', "holds neither"),
        ('{"s":["x"]}', "holds neither"),
        ('{"s":{"x":1}}', "holds neither"),
    ],
)
def test_unusable_shard_values_name_point_and_field(spark, payload, reason):
    points = routable(spark, payload)
    with pytest.raises(Exception, match=f"no shard for point 0: field s {reason}"):
        routing.route(points, field="s").collect()
    kept = routing.route_by_field(points, "s", mode="quarantine").first()
    assert kept["shard_key"] is None and reason in kept["reason"]


def test_route_options():
    with pytest.raises(ValueError, match="either a fixed shard key"):
        routing.check_route_options("a", "b")
    with pytest.raises(ValueError, match="onto itself"):
        routing.check_route_options(None, None, "c", "c")
    routing.check_route_options("a", None, "c", "d")


def test_a_dominant_shard_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 60_000, 1, 8)
        key = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
        points = to_points(
            rows,
            id=ids.numeric_id(F.col("id")),
            payload=F.to_variant_object(F.struct("id")),
            shard_key=F.when(
                F.col("id") > 9, F.struct(key.alias("keyword"), F.lit(None).alias("num")).cast(SHARD_KEY)
            ),
        )
        path = str(tmp_path / "out")
        routing.write_sharded(points, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folders = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert folders["shard=k%3Ahot"] > 1
    assert "shard=__HIVE_DEFAULT_PARTITION__" in folders
    assert routing.read_sharded(spark, path, points.schema.add("shard", "string")).count() == 60_000


# -- catalog -------------------------------------------------------------------


def mapping(spark, properties, index="idx"):
    body = json.dumps({index: {"mappings": {"properties": properties}}})
    return spark.createDataFrame([(body,)], "mapping string")


def found(params):
    return {r["name"]: (r["size"], r["distance"]) for r in params.collect()}


def test_es_mapping(spark):
    properties = {
        "a": {"type": "dense_vector", "dims": 3, "similarity": "L2_NORM"},
        "b": {"type": "dense_vector", "dims": 4.0, "similarity": "max_inner_product"},
        "c": {"type": "dense_vector", "dims": 5},
        "d": {"type": "dense_vector"},
        "e": {"type": "text"},
        "f": "odd",
        "g": {"type": "dense_vector", "dims": 6, "similarity": "hamming"},
    }
    assert found(catalog.params_from_es_mapping(mapping(spark, properties))) == {
        "a": (3, "euclid"), "b": (4, "dot"), "c": (5, "cosine"), "g": (6, "cosine")
    }
    with pytest.raises(Exception, match="the number of dimensions is not a number: field a"):
        catalog.params_from_es_mapping(mapping(spark, {"a": {"type": "dense_vector", "dims": "3"}})).collect()
    broken = spark.createDataFrame([('{"idx":{"mappings":{}}}',)], "mapping string")
    with pytest.raises(Exception, match="no field properties in the mapping"):
        catalog.params_from_es_mapping(broken).collect()


def test_os_mapping(spark):
    properties = {
        n: {"type": "knn_vector", "dimension": 2, "space_type": s}
        for n, s in {"a": "l2", "b": "cosinesimil", "c": "innerproduct", "d": "l1", "e": "linf"}.items()
    }
    assert found(catalog.params_from_os_mapping(mapping(spark, properties))) == {
        "a": (2, "euclid"), "b": (2, "cosine"), "c": (2, "dot"), "d": (2, "manhattan"), "e": (2, "cosine")
    }


def test_field_params(spark):
    fields = spark.createDataFrame(
        [("c", "v", "FloatVector", {"dim": "8"}), ("c", "w", "FloatVector", {"dim": "4"}), ("c", "t", "VarChar", {})],
        "collection string, name string, data_type string, type_params map<string,string>",
    )
    assert found(catalog.params_from_fields(fields, {"w": "manhattan"})) == {"v": (8, "cosine"), "w": (4, "manhattan")}
    with pytest.raises(ValueError, match="cannot be compared by 'hamming'"):
        catalog.params_from_fields(fields, {"w": "hamming"})
    with pytest.raises(Exception, match="no whole number of dimensions"):
        catalog.params_from_fields(fields.withColumn("type_params", F.lit(None).cast("map<string,string>"))).collect()


def test_single_vector_params(spark):
    indexes = spark.createDataFrame(
        [("a", "pinecone", "dotproduct", 3, "dense"), ("b", "pinecone", None, None, "sparse"),
         ("c", "s3_vectors", "euclidean", 4, None), ("d", "chroma", None, 5, None), ("e", "faiss", None, 6, None)],
        "collection string, source string, metric string, size bigint, vector_type string",
    )
    rows = {r["collection"]: (r["size"], r["distance"]) for r in catalog.params_single(indexes).collect()}
    assert rows == {"a": (3, "dot"), "b": (None, None), "c": (4, "euclid"), "d": (5, "euclid"), "e": (6, "cosine")}
    bad = indexes.where("collection = 'c'").withColumn("metric", F.lit("dotproduct"))
    with pytest.raises(Exception, match="no counterpart for the distance"):
        catalog.params_single(bad).collect()
    odd = indexes.where("collection = 'a'").withColumn("vector_type", F.lit("binary"))
    with pytest.raises(Exception, match="neither a dense nor a sparse index"):
        catalog.params_single(odd).collect()


def test_vector_columns_need_one_dimension(spark):
    rows = spark.sql("SELECT * FROM VALUES (array(1f,2f), array('x')), (array(3f), array('y')) AS t(v, s)")
    assert [tuple(r) for r in catalog.discover_vector_columns(rows.limit(1)).collect()] == [("v", 2)]
    for broken in (rows, rows.limit(0)):
        with pytest.raises(Exception, match="no single positive dimension"):
            catalog.discover_vector_columns(broken).collect()
    assert catalog.discover_vector_columns(rows.select("s")).count() == 0


def test_preparing_collections(spark):
    existing = spark.createDataFrame([("a", "auto")], "name string, sharding_method string")
    wanted = spark.createDataFrame([("a", "custom"), ("b", "custom")], "name string, sharding_method string")
    created = catalog.ensure_collections(existing, wanted)
    assert {tuple(r) for r in created.collect()} == {("a", "auto"), ("b", "custom")}
    assert catalog.ensure_collections(existing, wanted, "skip").count() == 1
    with pytest.raises(Exception, match="collection does not exist: b"):
        catalog.ensure_collections(existing, wanted, "require").collect()
    assert catalog.ensure_collections(existing, wanted.limit(1), "require").count() == 1
    with pytest.raises(Exception, match="its sharding is not custom"):
        catalog.check_routable(existing).collect()
    assert catalog.check_routable(wanted).count() == 2


# -- verification --------------------------------------------------------------


def pairs(spark, rows):
    rows = [(*r, None)[:4] for r in rows]
    frame = spark.createDataFrame(rows, "id int, x float, p string, shard string")
    return to_points(
        frame,
        shard_key=F.struct(F.col("shard").alias("keyword"), F.lit(None).alias("num")).cast(SHARD_KEY),
        id=ids.numeric_id(F.col("id")),
        dense=F.create_map(F.lit("v"), F.array("x")),
        payload=F.parse_json("p"),
    )


def test_every_status(spark):
    source = pairs(spark, [(1, 1.0, '{"a":1,"b":2}'), (2, 1.0, "{}"), (3, 1.0, "{}"), (4, 1.0, "{}"), (6, 1.0, "{}"), (6, 1.0, "{}"), (7, 1.0, "{}", "a"), (8, 1.0, "{}", "a")])
    target = pairs(spark, [(1, 1.0, '{"b":2,"a":1}'), (2, 1.5, "{}"), (3, 1.0, '{"a":1}'), (5, 1.0, "{}"), (6, 1.0, "{}"), (7, 1.0, "{}", "b"), (8, 1.0, "{}", "a")])
    statuses = {int(r["id"]["num"]): r["status"] for r in verify.compare(source, target).collect()}
    assert statuses == {1: "match", 2: "vector_differs", 3: "payload_differs", 4: "missing", 5: "unexpected", 6: "duplicate", 7: "shard_differs", 8: "match"}
    report = {r["status"]: r["points"] for r in verify.reconcile_report(source, target).collect()}
    assert report == {s: 1 + (s == "match") for s in verify.STATUSES}


def test_tolerant_comparison(spark):
    source = pairs(spark, [(1, 1.0, "{}"), (2, 1.0, "{}"), (3, 1.0, "{}")])
    target = pairs(spark, [(1, 1.009, "{}"), (2, 1.02, "{}"), (4, 1.0, "{}")])
    statuses = {int(r["id"]["num"]): r["status"] for r in verify.compare_within(source, target, "v").collect()}
    assert statuses == {1: "match", 2: "vector_differs", 3: "missing", 4: "unexpected"}


def test_counts_come_with_the_write(spark, tmp_path):
    rows, observation = verify.observe_count(spark.range(7))
    rows.write.parquet(str(tmp_path / "out"))
    assert observation.get["points"] == 7


def test_counts(spark):
    verdict = verify.count_check(spark.range(3), spark.range(2)).first()
    assert tuple(verdict) == (3, 2, "different")
    assert tuple(verify.count_check(spark.range(0), spark.range(0)).first()) == (0, 0, "equal")


def test_comparison_is_a_hash_aggregation_of_digests(spark):
    rows = pairs(spark, [(1, 1.0, "{}")])
    plan = verify.compare(rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Join" not in plan and plan.count("HashAggregate") == 2
