"""Readers, one query per record shape. Shapes are made from the given tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions import ids, vectors
from vecflow.operators.collection import StoredCollection
from vecflow.plans.ranges import plan_ranges, plan_rows
from vecflow.queries.registry import (
    REQUIRED_VECTOR_ROWS_SQL,
    VECTOR_ROWS_SQL,
    field,
    has_field,
    names_of,
    point_uuid,
    query,
    table,
    uuid5_sql,
    vec_sum,
    vec_sum_sql,
    required_vector_rows,
    vector_rows,
)
from vecflow.scratch import scratch_path
from vecflow.sources.collection import fetch_by_ids, scan_points as read_collection
from vecflow.sources.collection import select_partitions
from vecflow.sources.documents import (
    from_es_hits as es_points,
    from_mongo_docs as mongo_points,
    from_os_hits as os_points,
    from_solr_docs as solr_points,
)
from vecflow.sources.flat import from_flat_vectors as flat_points
from vecflow.sources.paged import PageRequest, arrow_condition, ranged_source
from vecflow.sources.relational import from_table as table_points
from vecflow.sources.stores import (
    from_chroma_get as chroma_points,
    from_milvus_columns as milvus_points,
    from_pinecone,
    from_redis_hashes as redis_points,
    from_s3_vectors as s3_points,
    from_weaviate_objects as weaviate_points,
)

DOC_ID_SQL = "'doc-' || vec_id"


def _doc_id():
    return F.concat(F.lit("doc-"), F.col("vec_id").cast("string"))


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id,
           CAST(len(embedding) AS BIGINT) AS dim, {vec_sum_sql("embedding")} AS vec_sum,
           vec_id, label, lang, md5(text) AS text_md5
    FROM {VECTOR_ROWS_SQL}
    """
)
def scan_points(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan-points")
    table_points(vector_rows(spark, folder), "vec_id").write.parquet(path)
    vector = F.col("dense")["embedding"]
    return read_collection(spark, path).select(
        point_uuid(),
        F.size(vector).cast("bigint").alias("dim"),
        vec_sum(vector).alias("vec_sum"),
        field("vec_id", "bigint").alias("vec_id"),
        field("label", "int").alias("label"),
        field("lang", "string").alias("lang"),
        F.md5(field("text", "string")).alias("text_md5"),
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id, vec_id, label,
           CAST(len(embedding) AS BIGINT) AS dim, {vec_sum_sql("embedding")} AS vec_sum,
           'embedding' AS vector_names
    FROM embeddings
    """
)
def from_table(spark: SparkSession, folder: str) -> DataFrame:
    vector = F.col("dense")["embedding"]
    return table_points(table(spark, folder, "embeddings"), "vec_id").select(
        point_uuid(),
        field("vec_id", "bigint").alias("vec_id"),
        field("label", "int").alias("label"),
        F.size(vector).cast("bigint").alias("dim"),
        vec_sum(vector).alias("vec_sum"),
        names_of(F.col("dense")).alias("vector_names"),
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(o_orderkey AS VARCHAR)")} AS id, o_orderkey, o_custkey,
           o_orderstatus, o_totalprice, o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate,
           CAST(0 AS BIGINT) AS vectors
    FROM orders
    """
)
def from_table_scalars(spark: SparkSession, folder: str) -> DataFrame:
    return table_points(table(spark, folder, "orders"), "o_orderkey").select(
        point_uuid(),
        field("o_orderkey", "bigint").alias("o_orderkey"),
        field("o_custkey", "bigint").alias("o_custkey"),
        field("o_orderstatus", "string").alias("o_orderstatus"),
        field("o_totalprice", "double").alias("o_totalprice"),
        field("o_orderpriority", "string").alias("o_orderpriority"),
        field("o_orderdate", "string").alias("o_orderdate"),
        F.size("dense").cast("bigint").alias("vectors"),
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(c_custkey AS VARCHAR)")} AS id, c_custkey, c_mktsegment,
           false AS has_name
    FROM customer
    """
)
def column_subset(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return table_points(customers, "c_custkey", columns=["c_custkey", "c_mktsegment"]).select(
        point_uuid(),
        field("c_custkey", "bigint").alias("c_custkey"),
        field("c_mktsegment", "string").alias("c_mktsegment"),
        has_field("c_name").alias("has_name"),
    )


def _record_json(*extra):
    """A document-store record: vectors, scalars, a mixed list and an empty one."""
    mixed = F.parse_json(F.concat(F.lit("["), F.col("n_chars").cast("string"), F.lit(',"a"]')))
    return F.to_json(
        F.struct(
            *extra,
            F.col("embedding").alias("vector"),
            F.col("lang").alias("doc"),
            F.col("text").alias("text"),
            F.col("n_chars").alias("n"),
            mixed.alias("mixed"),
            F.array().cast("array<int>").alias("empty"),
        )
    )


def _document_columns(points: DataFrame, *extra) -> DataFrame:
    vector = F.col("dense")["vector"]
    return points.select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        names_of(F.col("dense")).alias("vector_names"),
        F.size(vector).cast("bigint").alias("dim"),
        vec_sum(vector).alias("vec_sum"),
        field("doc", "string").alias("doc"),
        field("n", "bigint").alias("n"),
        F.md5(field("text", "string")).alias("text_md5"),
        has_field("mixed").alias("mixed_kept"),
        has_field("empty").alias("empty_kept"),
        *extra,
    )


def _document_sql(other_vectors: str, empty_kept: str, extra: str = "") -> str:
    """The same columns; ``other_vectors`` are the names of vectors that a record without its own still has."""
    names = ",".join(filter(None, [other_vectors, "vector"]))
    return f"""
    SELECT {uuid5_sql(DOC_ID_SQL)} AS id, {DOC_ID_SQL} AS original_id,
           CASE WHEN embedding IS NULL THEN '{other_vectors}' ELSE '{names}' END AS vector_names,
           CAST(len(embedding) AS BIGINT) AS dim, {vec_sum_sql("embedding")} AS vec_sum,
           lang AS doc, n_chars AS n, md5(text) AS text_md5,
           n_chars IS NOT NULL AS mixed_kept, {empty_kept} AS empty_kept {extra}
    FROM {VECTOR_ROWS_SQL}
    """


@query(_document_sql("", "true"))
def from_es_hits(spark: SparkSession, folder: str) -> DataFrame:
    hits = vector_rows(spark, folder).select(
        _doc_id().alias("_id"), F.parse_json(_record_json()).alias("_source")
    )
    return _document_columns(es_points(hits))


@query(_document_sql("", "true"))
def from_es_hits_struct(spark: SparkSession, folder: str) -> DataFrame:
    """The same records with a static schema: the split is decided without looking at values."""
    rows = vector_rows(spark, folder)
    source = F.struct(
        F.col("embedding").alias("vector"),
        F.col("lang").alias("doc"),
        "text",
        F.col("n_chars").alias("n"),
        F.when(F.col("n_chars").isNotNull(), F.array(F.col("n_chars").cast("string"), F.lit("a"))).alias("mixed"),
        F.array().cast("array<float>").alias("empty"),
    )
    return _document_columns(es_points(rows.select(_doc_id().alias("_id"), source.alias("_source"))))


@query(
    f"""
    SELECT {uuid5_sql(DOC_ID_SQL)} AS id,
           CASE WHEN embedding IS NULL THEN '' ELSE 'extra,vector' END AS vector_names,
           {vec_sum_sql("list_reverse(embedding)")} AS vector_sum,
           {vec_sum_sql("embedding")} AS extra_sum, false AS note_kept
    FROM {VECTOR_ROWS_SQL}
    """
)
def es_fields_overlay(spark: SparkSession, folder: str) -> DataFrame:
    overlay = F.to_json(
        F.struct(
            F.reverse("embedding").alias("vector"),
            F.col("embedding").alias("extra"),
            F.col("source").alias("note"),
        )
    )
    hits = vector_rows(spark, folder).select(
        _doc_id().alias("_id"), _record_json().alias("_source"), overlay.alias("fields")
    )
    return es_points(hits).select(
        point_uuid(),
        names_of(F.col("dense")).alias("vector_names"),
        vec_sum(F.col("dense")["vector"]).alias("vector_sum"),
        vec_sum(F.col("dense")["extra"]).alias("extra_sum"),
        has_field("note").alias("note_kept"),
    )


@query(_document_sql("empty", "false"))
def from_os_hits(spark: SparkSession, folder: str) -> DataFrame:
    hits = vector_rows(spark, folder).select(
        _doc_id().alias("_id"), _record_json().alias("_source")
    )
    return _document_columns(os_points(hits))


@query(_document_sql("empty", "false", f", {DOC_ID_SQL} AS id_in_payload"))
def from_solr_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = vector_rows(spark, folder).select(_record_json(_doc_id().alias("id")).alias("doc"))
    return _document_columns(solr_points(docs), field("id", "string").alias("id_in_payload"))


@query(
    f"""
    WITH records AS (
      SELECT '{{"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}}' AS r
      FROM orders),
    numbered AS (
      SELECT r, row_number() OVER (PARTITION BY r) - 1 AS occurrence FROM records)
    SELECT {uuid5_sql("r || '#' || occurrence")} AS id, r AS payload
    FROM numbered
    """
)
def missing_id(spark: SparkSession, folder: str) -> DataFrame:
    """Records without an id, most of them copies of one another."""
    docs = table(spark, folder, "orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
            )
        ).alias("doc")
    )
    points = solr_points(docs)
    return points.select(
        point_uuid(),
        F.to_json(
            F.struct(
                field("priority", "string").alias("priority"),
                field("status", "string").alias("status"),
            )
        ).alias("payload"),
    )


_OBJECT_ID_SQL = "lpad(lower(to_hex(vec_id)), 24, '0')"


@query(
    f"""
    SELECT {uuid5_sql(f"'ObjectID(\"' || {_OBJECT_ID_SQL} || '\")'")} AS id,
           'ObjectID("' || {_OBJECT_ID_SQL} || '")' AS original_id,
           CASE WHEN embedding IS NULL THEN '' ELSE 'image,text' END AS vector_names,
           {vec_sum_sql("embedding")} AS text_sum, {vec_sum_sql("list_reverse(embedding)")} AS image_sum,
           CAST(2 AS BIGINT) AS integers, CAST(len(embedding) AS BIGINT) AS unlisted,
           false AS native_id_kept, md5(text) AS text_md5
    FROM {VECTOR_ROWS_SQL}
    """
)
def from_mongo_docs(spark: SparkSession, folder: str) -> DataFrame:
    object_id = F.lpad(F.lower(F.hex("vec_id")), 24, "0")
    docs = vector_rows(spark, folder).select(
        F.to_json(
            F.struct(
                F.struct(object_id.alias("$oid")).alias("_id"),
                F.col("embedding").alias("text"),
                F.reverse("embedding").alias("image"),
                F.array("label", "n_chars").alias("integers"),
                F.col("embedding").alias("unlisted"),
                F.col("text").alias("body"),
            )
        ).alias("doc")
    )
    points = mongo_points(docs, ["text", "image", "integers"])
    return points.select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        names_of(F.col("dense")).alias("vector_names"),
        vec_sum(F.col("dense")["text"]).alias("text_sum"),
        vec_sum(F.col("dense")["image"]).alias("image_sum"),
        F.size(field("integers", "array<bigint>")).cast("bigint").alias("integers"),
        F.size(field("unlisted", "array<double>")).cast("bigint").alias("unlisted"),
        has_field("_id").alias("native_id_kept"),
        F.md5(field("body", "string")).alias("text_md5"),
    )


@query(
    f"""
    SELECT {uuid5_sql("'doc:' || vec_id")} AS id, 'doc:' || vec_id AS original_id,
           {vec_sum_sql("embedding")} AS vec_sum, CAST(n_chars AS DOUBLE) AS chars,
           lang AS genre, md5(text) AS content_md5
    FROM {VECTOR_ROWS_SQL}
    """
)
def from_redis_hashes(spark: SparkSession, folder: str) -> DataFrame:
    parts = {
        "content": F.encode("text", "UTF-8"),
        "genre": F.encode("lang", "UTF-8"),
        "chars": F.encode(F.col("n_chars").cast("string"), "UTF-8"),
        "embedding": vectors.floats_to_bytes(F.col("embedding")),
    }
    fields = F.create_map(*[x for name, value in parts.items() for x in (F.lit(name), value)])
    hashes = vector_rows(spark, folder).select(
        F.concat(F.lit("doc:"), F.col("vec_id").cast("string")).alias("key"),
        F.map_filter(fields, lambda _, value: value.isNotNull()).alias("fields"),
    )
    types = {"content": "TEXT", "genre": "TAG", "chars": "NUMERIC", "embedding": "VECTOR"}
    return redis_points(hashes, types).select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        vec_sum(F.col("dense")["embedding"]).alias("vec_sum"),
        field("chars", "double").alias("chars"),
        field("genre", "string").alias("genre"),
        F.md5(field("content", "string")).alias("content_md5"),
    )


@query(
    f"""
    SELECT upper({uuid5_sql(DOC_ID_SQL)}) AS id, {vec_sum_sql("embedding")} AS vec_sum,
           lang AS genre, md5(text) AS content_md5, false AS control_kept
    FROM {REQUIRED_VECTOR_ROWS_SQL}
    """
)
def from_weaviate_objects(spark: SparkSession, folder: str) -> DataFrame:
    objects = required_vector_rows(spark, folder).select(
        F.struct(
            F.upper(ids.uuid5(_doc_id())).alias("id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        ).alias("_additional"),
        F.col("text").alias("content"),
        F.col("lang").alias("genre"),
    )
    return weaviate_points(objects).select(
        point_uuid(),
        vec_sum(F.col("dense")[""]).alias("vec_sum"),
        field("genre", "string").alias("genre"),
        F.md5(field("content", "string")).alias("content_md5"),
        has_field("_additional").alias("control_kept"),
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id, CAST(vec_id AS VARCHAR) AS original_id,
           CAST(embedding IS NOT NULL AS BIGINT) AS vectors, {vec_sum_sql("embedding")} AS vec_sum, source, n_chars
    FROM {VECTOR_ROWS_SQL}
    """
)
def from_pinecone_dense(spark: SparkSession, folder: str) -> DataFrame:
    records = vector_rows(spark, folder).select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("values"),
        F.struct("source", "n_chars", F.lit("lost to the real id").alias("__id__")).alias("metadata"),
    )
    return from_pinecone(records).select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        F.size("dense").cast("bigint").alias("vectors"),
        vec_sum(F.col("dense")[""]).alias("vec_sum"),
        field("source", "string").alias("source"),
        field("n_chars", "bigint").alias("n_chars"),
    )


def _positive(vector):
    """Positions and values of the positive entries, as a sparse vector."""
    pairs = F.filter(
        F.transform(vector, lambda x, i: F.struct(i.cast("bigint").alias("i"), x.alias("x"))),
        lambda p: p["x"] > 0,
    )
    return F.struct(pairs["i"].alias("indices"), pairs["x"].alias("values"))


@query(
    f"""
    WITH entries AS (
      SELECT vec_id, i - 1 AS idx, embedding[i] AS x
      FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
      WHERE embedding[i] > 0)
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id, CAST(idx AS BIGINT) AS idx,
           CAST(x AS DOUBLE) AS value, CAST(0 AS BIGINT) AS dense_vectors
    FROM entries
    """
)
def from_pinecone_sparse(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.lit(None).cast("array<float>").alias("values"),
        _positive(F.col("embedding")).alias("sparse_values"),
    )
    points = from_pinecone(records, sparse_name="terms")
    as_map = vectors.sparse_as_map(F.col("sparse")["terms"])
    return points.select(
        point_uuid(),
        F.size("dense").cast("bigint").alias("dense_vectors"),
        F.explode(as_map).alias("idx", "value"),
    ).withColumn("value", F.col("value").cast("double"))


@query(
    f"""
    SELECT {uuid5_sql("'vector-' || vec_id")} AS id, 'vector-' || vec_id AS original_id,
           {vec_sum_sql("embedding")} AS vec_sum, CAST(label AS BIGINT) AS age, 'BIGINT' AS age_kind,
           n_chars / 4 AS ratio, lang AS city
    FROM {REQUIRED_VECTOR_ROWS_SQL}
    """
)
def from_s3_vectors(spark: SparkSession, folder: str) -> DataFrame:
    records = required_vector_rows(spark, folder).select(
        F.concat(F.lit("vector-"), F.col("vec_id").cast("string")).alias("key"),
        F.col("embedding").alias("data"),
        F.struct(
            F.col("label").cast("string").alias("age"),
            (F.col("n_chars") / 4).cast("string").alias("ratio"),
            F.col("lang").alias("city"),
        ).alias("metadata"),
    )
    return s3_points(records, number_fields=["age", "ratio"]).select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        vec_sum(F.col("dense")[""]).alias("vec_sum"),
        field("age", "bigint").alias("age"),
        F.schema_of_variant(field("age", "variant")).alias("age_kind"),
        field("ratio", "double").alias("ratio"),
        field("city", "string").alias("city"),
    )


def _pages(rows: DataFrame, **columns) -> DataFrame:
    """Pages of at most fifty records each, as a store hands them out."""
    record = F.struct("vec_id", *[c.alias(name) for name, c in columns.items()])
    return (
        rows.groupBy(F.floor(F.col("vec_id") / 50).alias("page"))
        .agg(F.sort_array(F.collect_list(record)).alias("_r"))
        .select(*[F.col("_r")[name].alias(name) for name in columns])
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id, CAST(vec_id AS VARCHAR) AS original_id,
           {vec_sum_sql("embedding")} AS vec_sum, source,
           CASE WHEN lang <> 'fr' THEN md5(text) END AS document_md5
    FROM {VECTOR_ROWS_SQL}
    """
)
def from_chroma_get(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(
        vector_rows(spark, folder),
        ids=F.col("vec_id").cast("string"),
        embeddings=F.col("embedding"),
        documents=F.when(F.col("lang") == "fr", "").otherwise(F.col("text")),
        metadatas=F.struct("source"),
    )
    return chroma_points(pages).select(
        point_uuid(),
        field("__id__", "string").alias("original_id"),
        vec_sum(F.col("dense")[""]).alias("vec_sum"),
        field("source", "string").alias("source"),
        F.md5(field("document", "string")).alias("document_md5"),
    )


@query(
    f"""
    SELECT CAST(vec_id AS VARCHAR) AS id, {vec_sum_sql("embedding")} AS vec_sum,
           CAST(label AS BIGINT) AS label, lang AS color, false AS key_kept
    FROM {REQUIRED_VECTOR_ROWS_SQL}
    """
)
def from_milvus_columns(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(
        required_vector_rows(spark, folder),
        pk=F.col("vec_id"),
        vector=F.col("embedding"),
        label=F.col("label"),
        color=F.col("lang"),
    )
    columnar = pages.withColumn("dim", F.size(F.col("vector")[0])).withColumn(
        "vector", F.flatten("vector")
    )
    return milvus_points(columnar, "pk", {"vector": F.col("dim")}).select(
        F.col("id.num").cast("string").alias("id"),
        vec_sum(F.col("dense")["vector"]).alias("vec_sum"),
        field("label", "bigint").alias("label"),
        field("color", "string").alias("color"),
        has_field("pk").alias("key_kept"),
    )


@query(
    f"""
    SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS VARCHAR) AS id,
           CAST(len(embedding) AS BIGINT) AS dim, {vec_sum_sql("embedding")} AS vec_sum,
           true AS no_payload
    FROM embeddings
    """
)
def from_flat_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors_table = table(spark, folder, "embeddings")
    path = scratch_path(spark, "flat-vectors")
    write_flat_files(vectors_table, "vec_id", "embedding", path)
    dim = vectors_table.agg(F.max(F.size("embedding"))).first()[0]
    return flat_points(spark, path, dim).select(
        F.col("id.num").cast("string").alias("id"),
        F.size(F.col("dense")[""]).cast("bigint").alias("dim"),
        vec_sum(F.col("dense")[""]).alias("vec_sum"),
        F.col("payload").isNull().alias("no_payload"),
    )


def write_flat_files(df: DataFrame, key: str, vector: str, path: str) -> None:
    """Export vectors in key order, one flat file per range of keys."""
    uri = path if "://" in path else f"file://{path}"

    def write(batches):
        number = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        # Written aside and renamed, so a repeated task replaces the file whole.
        draft = f"{root}/.part-{number:05d}-{TaskContext.get().taskAttemptId()}"
        count = 0
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                out.write(batch.column(0).flatten().cast(pa.float32()).to_numpy().tobytes())
                count += batch.num_rows
        fs.move(draft, f"{root}/part-{number:05d}.f32")
        yield pa.RecordBatch.from_pydict({"written": [count]})

    ordered = df.repartitionByRange(key).sortWithinPartitions(key).select(vector)
    ordered.mapInArrow(write, "written bigint").agg(F.sum("written")).collect()


class OrderedTable:
    """Stands in for a store with a cursor: one ordered scan per range, given out in pages."""

    def __init__(self, path: str, key: str):
        self.path, self.key = path, key

    def __call__(self, request: PageRequest):
        names = list(dict.fromkeys([*request.columns, self.key]))
        rows = pads.dataset(self.path).to_table(columns=names, filter=arrow_condition(request, self.key))
        rows = rows.sort_by(self.key)
        for start in range(0, rows.num_rows, request.limit):
            yield rows.slice(start, request.limit)


ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


def _paged_orders(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    orders = table(spark, folder, "orders")
    plan = plan_ranges(orders, "o_orderkey", 8, "orders", "paged", even=True)
    pages = OrderedTable(f"{folder}/orders.parquet", "o_orderkey")
    return ranged_source(spark, pages, plan_rows(plan, "bigint"), "o_orderkey", ORDERS_SCHEMA, 5000, columns)


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    """
)
def paged_source_scan(spark: SparkSession, folder: str) -> DataFrame:
    return _paged_orders(spark, folder, ["o_orderkey", "o_custkey", "o_totalprice"])


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey > 400 AND o_orderkey <= 20000 AND o_orderstatus = 'F' AND o_totalprice >= 1000
    """
)
def paged_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Key bounds narrow the ranges, the other conditions and three of four columns reach the source."""
    orders = _paged_orders(spark, folder, ["o_orderkey", "o_totalprice", "o_orderstatus"])
    wanted = orders.where("o_orderkey > 400 AND o_orderkey <= 20000 AND o_orderstatus = 'F' AND o_totalprice >= 1000")
    return wanted.select("o_orderkey", "o_totalprice")


@query("SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'fr')")
def partition_filter(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return select_partitions(documents, "lang", ["en", "fr"])


@query(
    f"""
    SELECT {uuid5_sql("CAST(doc_id AS VARCHAR)")} AS id, doc_id, lang, md5(text) AS text_md5
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    """,
    name="fetch_by_ids",
)
def fetch_by_ids_query(spark: SparkSession, folder: str) -> DataFrame:
    store = table_points(table(spark, folder, "documents"), "doc_id")
    listed = table(spark, folder, "labels").select(
        ids.text_id(F.col("doc_id").cast("string")).alias("id")
    )
    return fetch_by_ids(listed, store).select(
        point_uuid(),
        field("doc_id", "bigint").alias("doc_id"),
        field("lang", "string").alias("lang"),
        F.md5(field("text", "string")).alias("text_md5"),
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(doc_id AS VARCHAR)")} AS id, doc_id, lang, md5(text) AS text_md5
    FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
    """
)
def fetch_from_collection(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled documents out of a stored collection, by the buckets of their ids."""
    target = StoredCollection(spark, scratch_path(spark, "collection"), buckets=16)
    target.upsert(table_points(table(spark, folder, "documents"), "doc_id"))
    listed = table(spark, folder, "labels").select(
        ids.text_id(F.col("doc_id").cast("string")).alias("id")
    )
    return target.fetch(listed).select(
        point_uuid(),
        field("doc_id", "bigint").alias("doc_id"),
        field("lang", "string").alias("lang"),
        F.md5(field("text", "string")).alias("text_md5"),
    )
