import json

import pytest
from pyspark.sql import functions as F

from vecflow.functions.ids import arbitrary_id_to_uuid
from vecflow.sources import documents, stores
from vecflow.sources.relational import from_table, parse_vector_text, project_columns
from vecflow.sources.records import Rule, check_records, copies_with_ids, split_quarantined


def shown(points):
    out = {}
    for r in points.select("id", "dense", "sparse", F.to_json("payload").alias("payload")).collect():
        key = r["id"]["uuid"] or int(r["id"]["num"])
        out[key] = (r["dense"], r["sparse"], None if r["payload"] is None else json.loads(r["payload"]))
    return out


def only(points):
    (value,) = shown(points).values()
    return value


def test_table_with_mixed_columns(spark):
    rows = spark.sql(
        "SELECT 1 AS id, 'Entry 1' AS name, 1.5D AS height, true AS active, "
        "array(1f, 2f) AS embedding, CAST(NULL AS array<double>) AS other"
    )
    dense, _, payload = only(from_table(rows, "id"))
    assert dense == {"embedding": [1.0, 2.0]}
    assert payload == {"id": 1, "name": "Entry 1", "height": 1.5, "active": True}


def test_table_key_must_be_there(spark):
    rows = spark.sql("SELECT CAST(NULL AS int) AS id, 1 AS x")
    with pytest.raises(Exception, match="missing key"):
        from_table(rows, "id").collect()
    with pytest.raises(ValueError, match="must include the key"):
        project_columns(rows, "id", ["x"])
    with pytest.raises(ValueError, match="no such columns"):
        project_columns(rows, "id", ["id", "y"])


def test_column_subset_reaches_the_scan(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    points = from_table(customers, "c_custkey", ["c_custkey", "c_mktsegment"])
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "c_name" not in plan and "c_acctbal" not in plan


def test_vector_text_from_a_database(spark):
    rows = spark.sql("SELECT '[1,2.5,-3e-1]' AS v")
    assert parse_vector_text(rows, ["v"]).first()["v"] == pytest.approx([1, 2.5, -0.3])


def test_hits_from_json_lines(spark, tmp_path):
    hit = {"_id": "1", "_source": {"vector": [0.5, 1], "doc": "d", "tags": ["a"], "none": None, "empty": []},
           "fields": {"vector": [9.0], "extra": [1.0], "note": ["x"]}}
    (tmp_path / "hits.json").write_text(json.dumps(hit) + "\n")
    records = documents.read_json_records(spark, str(tmp_path)).select(
        F.variant_get("record", "$._id", "string").alias("_id"),
        F.variant_get("record", "$._source", "variant").alias("_source"),
        F.variant_get("record", "$.fields", "variant").alias("fields"),
    )
    dense, _, payload = only(documents.from_es_hits(records))
    assert dense == {"vector": [9.0], "extra": [1.0]}
    assert payload == {"doc": "d", "tags": ["a"], "none": None, "empty": [], "__id__": "1"}
    dense, _, payload = only(documents.from_os_hits(records.drop("fields")))
    assert dense == {"vector": [0.5, 1.0], "empty": []}
    assert payload == {"doc": "d", "tags": ["a"], "none": None, "__id__": "1"}


def test_hits_with_chosen_vector_fields(spark):
    hits = spark.createDataFrame([("1", '{"v":[1.5],"w":[2.5]}')], "_id string, _source string")
    dense, _, payload = only(documents.from_es_hits(hits, vector_fields=["v"]))
    assert dense == {"v": [1.5]} and payload == {"w": [2.5], "__id__": "1"}


@pytest.mark.parametrize("row", [(None, "{}"), ("1", None), ("1", "[1]")])
def test_malformed_hits_stop_the_job(spark, row):
    hits = spark.createDataFrame([row], "_id string, _source string")
    with pytest.raises(Exception):
        documents.from_es_hits(hits).collect()


def test_solr_documents_without_id_do_not_collide(spark):
    docs = spark.createDataFrame(
        [('{"id":"a","v":[1.5]}',), ('{"t":1}',), ('{"t":1}',), ('{"t":2}',)], "doc string"
    )
    points = shown(documents.from_solr_docs(docs))
    assert len(points) == 4
    again = shown(documents.from_solr_docs(docs.repartition(3)))
    assert again == points
    with pytest.raises(Exception, match="id is missing"):
        documents.from_solr_docs(docs, missing_ids="fail").collect()
    one = documents.from_solr_docs(docs.where("doc like '%id%'"), missing_ids="fail")
    assert only(one)[2] == {"id": "a", "__id__": "a"}


def test_many_copies_are_numbered_without_gaps(spark):
    records = spark.range(200_000).select(F.lit("{}").alias("record"))
    numbered = copies_with_ids(records)
    summary = numbered.agg(
        F.count("*"), F.countDistinct("record_id"), F.min("occurrence"), F.max("occurrence")
    ).first()
    assert list(summary) == [200_000, 200_000, 0, 199_999]
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1


def test_mongo_documents(spark):
    docs = spark.createDataFrame(
        [('{"_id":{"$oid":"507f1f77bcf86cd799439011"},"v":[1.5],"non_vector":[1.5],"ints":[1],"n":5}',),
         ('{"_id":"text","v":"not a list"}',)],
        "doc string",
    )
    points = list(shown(documents.from_mongo_docs(docs, ["v", "ints"])).values())
    points.sort(key=lambda p: p[2]["__id__"])
    assert points[0][0] == {"v": [1.5]}
    assert points[0][2] == {
        "__id__": 'ObjectID("507f1f77bcf86cd799439011")', "non_vector": [1.5], "ints": [1], "n": 5
    }
    assert points[1][0] == {} and points[1][2] == {"__id__": "text", "v": "not a list"}


@pytest.mark.parametrize("doc", ['{"_id":7}', '{"_id":null}', '{"a":1}'])
def test_mongo_id_types(spark, doc):
    docs = spark.createDataFrame([(doc,)], "doc string")
    with pytest.raises(Exception, match="_id is neither"):
        documents.from_mongo_docs(docs, []).collect()


def test_redis_hash(spark):
    hashes = spark.sql(
        "SELECT 'doc:1' AS key, map('content', encode('hi','UTF-8'), 'n', encode('7','UTF-8'), "
        "'__id__', encode('x','UTF-8'), 'embedding', unhex('0000803F00000040')) AS fields"
    )
    types = {"content": "TEXT", "n": "NUMERIC", "embedding": "VECTOR"}
    dense, _, payload = only(stores.from_redis_hashes(hashes, types))
    assert dense == {"embedding": [1.0, 2.0]}
    assert payload == {"content": "hi", "n": 7.0, "__id__": "doc:1"}
    untyped = hashes.withColumn("fields", F.map_filter("fields", lambda k, _: k != "embedding"))
    dense, _, payload = only(stores.from_redis_hashes(untyped, {}))
    assert dense == {} and payload["n"] == "7"


def test_weaviate_object(spark):
    objects = spark.sql(
        "SELECT named_struct('id', '6F1E9D2A-1234-4abc-8def-0123456789AB', 'vector', array(1D, 2D)) "
        "AS _additional, 'c' AS content"
    )
    points = shown(stores.from_weaviate_objects(objects))
    assert points == {"6F1E9D2A-1234-4abc-8def-0123456789AB": ({"": [1.0, 2.0]}, None, {"content": "c"})}


@pytest.mark.parametrize(
    "additional,reason",
    [
        ("CAST(NULL AS struct<id:string,vector:array<double>>)", "_additional is missing"),
        ("named_struct('id', CAST(NULL AS string), 'vector', array(1D))", "id is missing"),
        ("named_struct('id', 'x', 'vector', array(1D))", "not a UUID"),
        ("named_struct('id', uuid(), 'vector', CAST(NULL AS array<double>))", "vector is missing"),
        ("named_struct('id', uuid(), 'vector', array(1D, NULL))", "non-number"),
    ],
)
def test_malformed_weaviate_objects(spark, additional, reason):
    objects = spark.sql(f"SELECT {additional} AS _additional")
    with pytest.raises(Exception, match=reason):
        stores.from_weaviate_objects(objects).collect()


def test_pinecone_dense_sparse_and_neither(spark):
    records = spark.sql(
        "SELECT * FROM VALUES "
        "('1', array(1f), NULL, map('a', 'x')), "
        "('2', NULL, named_struct('indices', array(4294967295L), 'values', array(0.5f)), NULL), "
        "('3', NULL, NULL, map('__id__', 'lost')) AS t(id, values, sparse_values, metadata)"
    )
    points = list(shown(stores.from_pinecone(records, sparse_name="terms")).values())
    points.sort(key=lambda p: p[2]["__id__"])
    assert points[0] == ({"": [1.0]}, {}, {"a": "x", "__id__": "1"})
    assert points[1][1]["terms"].indices == [4294967295] and points[1][0] == {}
    assert points[2] == ({}, {}, {"__id__": "3"})


@pytest.mark.parametrize("reader", [stores.from_pinecone, lambda d: stores.from_redis_hashes(d, {})])
def test_missing_ids_stop_the_job(spark, reader):
    rows = spark.sql("SELECT CAST(NULL AS string) AS id, CAST(NULL AS string) AS key, "
                     "CAST(NULL AS map<string,binary>) AS fields")
    with pytest.raises(Exception, match="id is missing"):
        reader(rows).collect()


def test_s3_vectors_metadata_forms(spark):
    base = "SELECT 'vector-0' AS key, array(0.5f) AS data, "
    as_json = spark.sql(base + """'{"age":30,"ratio":1.5,"deep":[{"n":7}]}' AS metadata""")
    as_text = spark.sql(base + "map('age', '30', 'ratio', '1.5', 'zip', '01234') AS metadata")
    assert only(stores.from_s3_vectors(as_json))[2] == {
        "age": 30, "ratio": 1.5, "deep": [{"n": 7}], "__id__": "vector-0"
    }
    assert only(stores.from_s3_vectors(as_text, number_fields=["age", "ratio"]))[2] == {
        "age": 30, "ratio": 1.5, "zip": "01234", "__id__": "vector-0"
    }
    with pytest.raises(Exception, match="not a float vector"):
        stores.from_s3_vectors(as_json.withColumn("data", F.lit(None).cast("array<float>"))).collect()


def test_chroma_page(spark):
    pages = spark.sql(
        "SELECT array('1','2') AS ids, array(array(1f), array(2f)) AS embeddings, "
        "array('text', '') AS documents, array(named_struct('source','s'), NULL) AS metadatas"
    )
    points = sorted(shown(stores.from_chroma_get(pages)).values(), key=lambda p: p[2]["__id__"])
    assert points[0] == ({"": [1.0]}, None, {"source": "s", "__id__": "1", "document": "text"})
    assert points[1] == ({"": [2.0]}, None, {"__id__": "2"})


@pytest.mark.parametrize("embeddings,fine", [([[1.0]], False), ([[1.0], [2.0]], True), ([], True), (None, True), ([None, [2.0]], True)])
def test_chroma_embeddings_come_for_all_ids_or_none(spark, embeddings, fine):
    schema = "ids array<string>, embeddings array<array<float>>, documents array<string>, metadatas array<struct<a int>>"
    points = stores.from_chroma_get(spark.createDataFrame([(["1", "2"], embeddings, ["x"], None)], schema))
    if fine:
        assert points.count() == 2 and len(points.collect()) == 2
    else:
        with pytest.raises(Exception, match="embeddings are fewer than ids"):
            points.collect()


def test_chroma_page_without_an_array_keeps_its_records(spark):
    pages = spark.sql(
        "SELECT array('1','2') AS ids, array(array(1f), array(2f)) AS embeddings, "
        "CAST(NULL AS array<string>) AS documents, CAST(NULL AS array<struct<source string>>) AS metadatas"
    )
    assert {p[2]["__id__"] for p in shown(stores.from_chroma_get(pages)).values()} == {"1", "2"}


def test_milvus_page(spark):
    page = spark.sql(
        "SELECT array(7L, 8L) AS pk, array(1f,2f,3f,4f) AS v, array('red','blue') AS color, "
        "array(CAST(1 AS tinyint), CAST(2 AS tinyint)) AS small, "
        "array(parse_json('{\"a\":1}'), parse_json('{}')) AS doc"
    )
    points = shown(stores.from_milvus_columns(page, "pk", {"v": 2}))
    assert points == {
        7: ({"v": [1.0, 2.0]}, None, {"color": "red", "small": 1, "doc": {"a": 1}}),
        8: ({"v": [3.0, 4.0]}, None, {"color": "blue", "small": 2, "doc": {}}),
    }
    by_name = shown(stores.from_milvus_columns(page.select("v", F.col("color").alias("pk")), "pk", {"v": 2}))
    expected = spark.range(1).select(arbitrary_id_to_uuid(F.lit("red"))).first()[0]
    assert expected in by_name
    empty = page.select(F.expr("slice(pk, 1, 0)").alias("pk"), F.expr("slice(v, 1, 0)").alias("v"))
    assert stores.from_milvus_columns(empty, "pk", {"v": 2}).count() == 0
    with pytest.raises(Exception, match="do not fill the page"):
        stores.from_milvus_columns(page.withColumn("v", F.expr("slice(v, 1, 3)")), "pk", {"v": 2}).collect()
    with pytest.raises(ValueError, match="unsupported type of field"):
        stores.from_milvus_columns(page.withColumn("d", F.expr("array(1.5BD, 2.5BD)")), "pk", {"v": 2})


def test_bad_records_fail_or_are_set_aside(spark):
    rows = spark.createDataFrame([(1,), (None,), (-1,)], "id int")
    rules = [Rule("missing", F.col("id").isNull()), Rule("negative", F.col("id") < 0)]
    good, bad = split_quarantined(check_records(rows, rules, "quarantine"))
    assert [r["id"] for r in good.collect()] == [1]
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {(None, "missing"), (-1, "negative")}
    with pytest.raises(Exception, match="bad record: "):
        check_records(rows, rules).collect()
    with pytest.raises(ValueError):
        check_records(rows, rules, "ignore")


def test_typed_documents_give_the_same_points_as_json(spark):
    solr = spark.sql(
        "SELECT named_struct('id', CASE WHEN id % 2 = 0 THEN string(id) END, 'v', array(float(id), 0.5f), "
        "'tags', array('a'), 't', 'x') AS doc FROM range(10)"
    )
    as_json = solr.select(F.to_json("doc").alias("doc"))
    assert shown(documents.from_solr_docs(solr)) == shown(documents.from_solr_docs(as_json))
    mongo = spark.sql(
        "SELECT named_struct('_id', named_struct('$oid', lpad(string(id), 24, '0')), 'v', array(0.5D, 1.5D), "
        "'w', array(id), 'n', id) AS doc FROM range(5)"
    )
    as_json = mongo.select(F.to_json("doc").alias("doc"))
    typed = shown(documents.from_mongo_docs(mongo, ["v", "w"]))
    assert typed == shown(documents.from_mongo_docs(as_json, ["v", "w"])) and len(typed) == 5
    text_ids = mongo.select(F.struct(F.lit("a").alias("_id")).alias("doc")).limit(1)
    assert only(documents.from_mongo_docs(text_ids, []))[2] == {"__id__": "a"}
    with pytest.raises(Exception, match="_id is neither"):
        documents.from_mongo_docs(text_ids.select(F.struct(F.lit(7).alias("_id")).alias("doc")), []).collect()
