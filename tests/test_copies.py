"""Whole copies of small collections, one per record shape, compared point by point."""

import json
import struct
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecflow.operators import routing, verify
from vecflow.operators.collection import StoredCollection
from vecflow.sources import documents, stores
from vecflow.sources.flat import from_flat_vectors
from vecflow.sources.relational import from_table

COUNT, DIM = 100, 384
VECTORS = np.random.default_rng(7).random((COUNT, DIM)).astype(np.float32)
LISTS = [[float(x) for x in v] for v in VECTORS]


def hashed(text):
    return str(uuid.uuid5(uuid.NAMESPACE_URL, text))


def relational(spark, _):
    rows = [(i, f"Entry {i}", i, 1.5 + i / 100, i % 2 == 0, LISTS[i]) for i in range(COUNT)]
    schema = "id int, name string, age int, height double, is_active boolean, embedding array<float>"
    expected = {
        hashed(str(i)): ({"embedding": LISTS[i]},
                         {"id": i, "name": f"Entry {i}", "age": i, "height": 1.5 + i / 100, "is_active": i % 2 == 0})
        for i in range(COUNT)
    }
    return from_table(spark.createDataFrame(rows, schema), "id"), expected


def hits(reader):
    def make(spark, _):
        rows = [
            (str(i + 1), json.dumps({"vector": LISTS[i], "doc": f"text {i}", "source": "test"}))
            for i in range(COUNT)
        ]
        frame = spark.createDataFrame(rows, "_id string, _source string")
        return reader(frame), {
            hashed(k): ({"vector": LISTS[i]}, {"doc": f"text {i}", "source": "test", "__id__": k})
            for i, (k, _) in enumerate(rows)
        }

    return make


def solr(spark, _):
    rows = [
        (json.dumps({"id": f"doc-{i + 1}", "vector": LISTS[i], "doc": f"text {i}"}),) for i in range(COUNT)
    ]
    return documents.from_solr_docs(spark.createDataFrame(rows, "doc string")), {
        hashed(f"doc-{i + 1}"): (
            {"vector": LISTS[i]},
            {"id": f"doc-{i + 1}", "doc": f"text {i}", "__id__": f"doc-{i + 1}"},
        )
        for i in range(COUNT)
    }


def mongo(spark, _):
    rows = [
        (json.dumps({"_id": str(i), "text_embedding": LISTS[i], "image_embedding": LISTS[-1 - i],
                     "doc": f"text {i}", "non_vector": [1, 2, 3, 4, 5]}),)
        for i in range(COUNT)
    ]
    frame = spark.createDataFrame(rows, "doc string")
    return documents.from_mongo_docs(frame, ["text_embedding", "image_embedding"]), {
        hashed(str(i)): (
            {"text_embedding": LISTS[i], "image_embedding": LISTS[-1 - i]},
            {"doc": f"text {i}", "non_vector": [1, 2, 3, 4, 5], "__id__": str(i)},
        )
        for i in range(COUNT)
    }


def redis(spark, _):
    rows = [
        (f"doc:{i}", {"content": bytearray(f"text {i}".encode()), "genre": bytearray(b"technology"),
                      "embedding": bytearray(VECTORS[i].tobytes())})
        for i in range(COUNT)
    ]
    frame = spark.createDataFrame(rows, "key string, fields map<string,binary>")
    types = {"content": "TEXT", "genre": "TAG", "embedding": "VECTOR"}
    return stores.from_redis_hashes(frame, types), {
        hashed(f"doc:{i}"): (
            {"embedding": LISTS[i]},
            {"content": f"text {i}", "genre": "technology", "__id__": f"doc:{i}"},
        )
        for i in range(COUNT)
    }


def weaviate(spark, _):
    ids = [str(uuid.UUID(int=i + 1)) for i in range(COUNT)]
    rows = [((ids[i], LISTS[i]), f"text {i}", "technology") for i in range(COUNT)]
    schema = "_additional struct<id string, vector array<double>>, content string, genre string"
    return stores.from_weaviate_objects(spark.createDataFrame(rows, schema)), {
        ids[i]: ({"": LISTS[i]}, {"content": f"text {i}", "genre": "technology"}) for i in range(COUNT)
    }


def pinecone(spark, _):
    rows = [(str(i + 1), LISTS[i], ("test",)) for i in range(COUNT)]
    schema = "id string, values array<float>, metadata struct<source string>"
    return stores.from_pinecone(spark.createDataFrame(rows, schema)), {
        hashed(str(i + 1)): ({"": LISTS[i]}, {"source": "test", "__id__": str(i + 1)}) for i in range(COUNT)
    }


def s3_vectors(spark, _):
    rows = [
        (f"vector-{i}", LISTS[i], json.dumps({"age": 20 + i, "name": f"n{i}", "city": "c"}))
        for i in range(COUNT)
    ]
    frame = spark.createDataFrame(rows, "key string, data array<float>, metadata string")
    return stores.from_s3_vectors(frame), {
        hashed(f"vector-{i}"): (
            {"": LISTS[i]}, {"age": 20 + i, "name": f"n{i}", "city": "c", "__id__": f"vector-{i}"}
        )
        for i in range(COUNT)
    }


def chroma(spark, _):
    page = range(10)
    rows = [
        ([str(10 * p + i + 1) for i in page], [LISTS[10 * p + i] for i in page],
         [f"text {10 * p + i}" for i in page], [("test",)] * 10)
        for p in range(COUNT // 10)
    ]
    schema = ("ids array<string>, embeddings array<array<float>>, documents array<string>, "
              "metadatas array<struct<source string>>")
    return stores.from_chroma_get(spark.createDataFrame(rows, schema)), {
        hashed(str(i + 1)): (
            {"": LISTS[i]}, {"source": "test", "__id__": str(i + 1), "document": f"text {i}"}
        )
        for i in range(COUNT)
    }


def milvus(spark, _):
    rows = [
        (list(range(p, p + 10)), [x for i in range(p, p + 10) for x in LISTS[i]], ["red"] * 10)
        for p in range(0, COUNT, 10)
    ]
    frame = spark.createDataFrame(rows, "id array<bigint>, vector array<float>, color array<string>")
    return stores.from_milvus_columns(frame, "id", {"vector": DIM}), {
        i: ({"vector": LISTS[i]}, {"color": "red"}) for i in range(COUNT)
    }


def flat(spark, folder):
    (folder / "index.f32").write_bytes(b"".join(struct.pack(f"<{DIM}f", *v) for v in LISTS))
    return from_flat_vectors(spark, str(folder / "index.f32"), DIM), {
        i: ({"": LISTS[i]}, None) for i in range(COUNT)
    }


SHAPES = {
    "relational": relational,
    "elasticsearch": hits(documents.from_es_hits),
    "opensearch": hits(documents.from_os_hits),
    "solr": solr,
    "mongo": mongo,
    "redis": redis,
    "weaviate": weaviate,
    "pinecone": pinecone,
    "s3_vectors": s3_vectors,
    "chroma": chroma,
    "milvus": milvus,
    "flat": flat,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_every_point_arrives_unchanged(spark, tmp_path, shape):
    points, expected = SHAPES[shape](spark, tmp_path)
    target = StoredCollection(spark, str(tmp_path / "target"), buckets=2)
    assert target.upsert(points) == COUNT
    stored = target.points()
    assert [tuple(r) for r in verify.reconcile_report(points, stored).collect()] == [("match", COUNT)]
    got = {}
    for r in stored.select("id", "dense", F.to_json("payload").alias("p")).collect():
        key = r["id"]["uuid"] or int(r["id"]["num"])
        got[key] = (r["dense"], None if r["p"] is None else json.loads(r["p"]))
    assert got == expected


@pytest.mark.parametrize("choice", ["preserve", "field", "fixed"])
def test_sharded_copies(spark, tmp_path, choice):
    rows = [(i, LISTS[i], "shard_a" if i < 50 else "shard_b") for i in range(COUNT)]
    points = from_table(spark.createDataFrame(rows, "id int, v array<float>, shard string"), "id")
    if choice == "preserve":
        routed = routing.route(routing.route(points, field="shard"))
    else:
        routed = routing.route(points, **({"field": "shard"} if choice == "field" else {"fixed": "one"}))
    routing.write_sharded(routed, str(tmp_path / "out"))
    counts = routing.read_sharded(
        spark, str(tmp_path / "out"), routed.schema.add("shard", "string")
    ).groupBy("shard").count()
    expected = {"k:one": 100} if choice == "fixed" else {"k:shard_a": 50, "k:shard_b": 50}
    assert {r["shard"]: r["count"] for r in counts.collect()} == expected
