"""Ids, vectors and payload values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids, payload, vectors
from vecflow.queries.registry import (
    field,
    names_of,
    query,
    table,
    uuid5_sql,
    vec_sum,
    vec_sum_sql,
)
from vecflow.sources.records import Rule, check_records


@query(
    f"""
    SELECT 'url' AS kind, page_id AS item, {uuid5_sql("url")} AS id FROM pages
    UNION ALL SELECT 'html', page_id, {uuid5_sql("html")} FROM pages
    UNION ALL SELECT 'text', doc_id, {uuid5_sql("text")} FROM documents
    """
)
def uuid5_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of whole texts, non-ASCII ones among them."""
    pages, documents = table(spark, folder, "pages"), table(spark, folder, "documents")
    parts = [
        pages.select(F.lit("url").alias("kind"), F.col("page_id").alias("item"), "url"),
        pages.select(F.lit("html"), "page_id", "html"),
        documents.select(F.lit("text"), "doc_id", "text"),
    ]
    texts = parts[0].union(parts[1]).union(parts[2])
    return texts.select("kind", "item", ids.arbitrary_id_to_uuid(F.col("url")).alias("id"))


_SPELLED_SQL = f"""
    SELECT o_orderkey, CASE o_orderstatus
             WHEN 'F' THEN upper(u) WHEN 'O' THEN 'urn:uuid:' || u ELSE '{{' || u || '}}' END AS wrapped,
           replace(u, '-', '') AS bare, u || '0' AS long
    FROM (SELECT *, {uuid5_sql("CAST(o_orderkey AS VARCHAR)")} AS u FROM orders)
"""


@query(
    f"""
    SELECT o_orderkey, wrapped AS wrapped_id, bare AS bare_id, {uuid5_sql("long")} AS long_id
    FROM ({_SPELLED_SQL})
    """
)
def uuid_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted spelling is kept as it is, a nearly valid one is hashed."""
    u = ids.uuid5(F.col("o_orderkey").cast("string"))
    wrapped = (
        F.when(F.col("o_orderstatus") == "F", F.upper(u))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("urn:uuid:"), u))
        .otherwise(F.concat(F.lit("{"), u, F.lit("}")))
    )
    spelled = table(spark, folder, "orders").select(
        "o_orderkey",
        wrapped.alias("wrapped"),
        F.replace(u, F.lit("-"), F.lit("")).alias("bare"),
        F.concat(u, F.lit("0")).alias("long"),
    )
    return spelled.select(
        "o_orderkey",
        *[
            ids.arbitrary_id_to_uuid(F.col(c)).alias(f"{c}_id") for c in ("wrapped", "bare", "long")
        ],
    )


@query(
    """
    SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
           || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS from_sixteen_bytes,
           o_orderpriority AS from_other_bytes, CAST(o_orderkey AS VARCHAR) AS from_number
    FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)
    """
)
def key_to_string(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumns(
        {
            "digest": F.unhex(F.md5(F.col("o_orderkey").cast("string"))),
            "raw": F.encode("o_orderpriority", "UTF-8"),
        }
    )
    return orders.select(
        "o_orderkey",
        ids.key_to_string(F.col("digest"), T.BinaryType()).alias("from_sixteen_bytes"),
        ids.key_to_string(F.col("raw"), T.BinaryType()).alias("from_other_bytes"),
        ids.key_to_string(F.col("o_orderkey"), T.LongType()).alias("from_number"),
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id,
           CAST(CAST(o_orderkey AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS large_id
    FROM orders
    """
)
def numeric_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids beyond the signed range keep every digit."""
    large = F.col("o_orderkey").cast("decimal(20,0)") + F.lit("9223372036854775808").cast(
        "decimal(20,0)"
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        ids.id_text(ids.numeric_id(F.col("o_orderkey"))).alias("id"),
        ids.id_text(ids.numeric_id(large)).alias("large_id"),
    )


@query(
    f"""
    SELECT n, u FROM (
      SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END AS n,
             CASE WHEN c_mktsegment = 'BUILDING' THEN {uuid5_sql("c_name")} END AS u FROM customer)
    ORDER BY coalesce(u, ''), CAST(n AS BIGINT)
    """
)
def point_id_order(spark: SparkSession, folder: str) -> DataFrame:
    """A collection with both kinds of ids, in id order (a range-partitioned sort)."""
    as_uuid = F.col("c_mktsegment") == "BUILDING"
    point_id = F.when(as_uuid, ids.uuid_id(ids.uuid5(F.col("c_name")))).otherwise(
        ids.numeric_id(F.col("c_custkey"))
    )
    points = table(spark, folder, "customer").select(point_id.alias("id"))
    return points.orderBy(*ids.id_sort_columns()).select(
        F.col("id.num").cast("string").alias("n"), F.col("id.uuid").alias("u")
    )


@query(
    """
    SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE CAST(doc_id AS VARCHAR) END
             AS document_wins,
           CAST(doc_id AS VARCHAR) AS id_wins, lang
    FROM documents
    """
)
def id_field_precedence(spark: SparkSession, folder: str) -> DataFrame:
    """English documents already carry a field of the id field's name."""
    documents = table(spark, folder, "documents")
    own = F.to_variant_object(F.struct(F.col("source").alias("__id__"), "lang"))
    bare = F.to_variant_object(F.struct("lang"))
    fields = payload.object_fields(F.when(F.col("lang") == "en", own).otherwise(bare))
    original = F.col("doc_id").cast("string")

    def read(column, name):
        return F.try_variant_get(column, f"$.{name}", "string")

    both = documents.select(
        "doc_id",
        *[
            payload.pack_fields(payload.with_id_field(fields, "__id__", original, wins)).alias(name)
            for name, wins in (("d", True), ("i", False))
        ],
    )
    return both.select(
        "doc_id",
        read("d", "__id__").alias("document_wins"),
        read("i", "__id__").alias("id_wins"),
        read("i", "lang").alias("lang"),
    )


@query(
    """
    SELECT p_partkey, 'ints,mixed' AS es, 'empty,ints,mixed' AS os, 'empty' AS mongo,
           CAST(p_size AS DOUBLE) + 1 AS int_total
    FROM part
    """
)
def numeric_array_split(spark: SparkSession, folder: str) -> DataFrame:
    """Which of a record's lists become vectors under each source's rule."""
    size = F.col("p_size").cast("string")
    lists = {
        "ints": F.concat(F.lit("["), size, F.lit(",1]")),
        "mixed": F.concat(F.lit("[1.5,"), size, F.lit("]")),
        "with_null": F.concat(F.lit("["), size, F.lit(",null]")),
        "with_text": F.concat(F.lit("["), size, F.lit(',"7"]')),
        "with_bool": F.concat(F.lit("["), size, F.lit(",true]")),
        "nested": F.concat(F.lit("[["), size, F.lit("]]")),
        "scalar": size,
        "empty": F.lit("[]"),
    }
    record = F.concat(
        F.lit("{"),
        F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in lists.items()]),
        F.lit("}"),
    )
    fields = table(spark, folder, "part").select(
        "p_partkey", payload.object_fields(F.parse_json(record)).alias("fields")
    )

    def chosen(empty_is_vector: bool, floats_only: bool = False):
        return names_of(
            F.map_filter(
                F.col("fields"),
                lambda _, v: vectors.is_numeric_array(v, empty_is_vector, floats_only),
            )
        )

    ints = vectors.numeric_array(F.col("fields")["ints"], empty_is_vector=False)
    return fields.select(
        "p_partkey",
        chosen(False).alias("es"),
        chosen(True).alias("os"),
        chosen(True, True).alias("mongo"),
        F.aggregate(ints, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("int_total"),
    )


@query(
    f"""
    SELECT vec_id, 'full' AS kept, 'extra,full' AS normalized_named, '' AS normalized_single,
           {vec_sum_sql("embedding")} AS vec_sum
    FROM embeddings
    """
)
def drop_empty_vectors(spark: SparkSession, folder: str) -> DataFrame:
    empty = F.array().cast("array<float>")
    full = F.col("embedding")
    no_names = F.lit(None).cast("map<string,array<float>>")
    return table(spark, folder, "embeddings").select(
        "vec_id",
        names_of(
            vectors.drop_empty_vectors(F.create_map(F.lit("full"), full, F.lit("empty"), empty))
        ).alias("kept"),
        names_of(
            vectors.normalize_vector_set(
                empty, F.create_map(F.lit("full"), full, F.lit("extra"), full)
            )
        ).alias("normalized_named"),
        names_of(vectors.normalize_vector_set(full, no_names)).alias("normalized_single"),
        vec_sum(vectors.normalize_vector_set(full, no_names)[""]).alias("vec_sum"),
    )


@query(
    f"""
    SELECT vec_id, 'd' AS dense_names, 's' AS sparse_names, 'm' AS multi_names,
           CAST(2 AS BIGINT) AS rows_in_multi, {vec_sum_sql("embedding")} AS vec_sum
    FROM embeddings
    """
)
def vector_precedence(spark: SparkSession, folder: str) -> DataFrame:
    """Names offered in several forms: sparse beats multi beats dense."""
    v = F.col("embedding")
    one_sparse = vectors.make_sparse(F.array(F.col("label")), F.array(v[0]))
    multi = F.array(v, F.reverse(v))
    dense, sparse, multi_kept = vectors.convert_vectors(
        F.create_map(F.lit("s"), v, F.lit("m"), v, F.lit("d"), v),
        F.create_map(F.lit("s"), one_sparse),
        F.create_map(F.lit("s"), multi, F.lit("m"), multi),
    )
    return table(spark, folder, "embeddings").select(
        "vec_id",
        names_of(dense).alias("dense_names"),
        names_of(sparse).alias("sparse_names"),
        names_of(multi_kept).alias("multi_names"),
        F.size(multi_kept["m"]).cast("bigint").alias("rows_in_multi"),
        vec_sum(dense["d"]).alias("vec_sum"),
    )


@query(
    """
    SELECT vec_id, CAST(i - 1 AS BIGINT) AS idx, CAST(embedding[i] AS DOUBLE) AS value
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    """
)
def sparse_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("embedding")
    indices = F.transform(v, lambda _, i: i.cast("bigint"))
    sparse = vectors.make_sparse(F.reverse(indices), F.reverse(v))
    rows = table(spark, folder, "embeddings").select("vec_id", sparse.alias("sparse"))
    as_map = vectors.sparse_as_map(F.col("sparse"))
    return rows.select("vec_id", F.explode(as_map).alias("idx", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


@query(
    """
    SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    """
)
def le_float_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and back; every vector's last bytes are an incomplete float to drop."""
    raw = table(spark, folder, "embeddings").select(
        "vec_id",
        F.concat(vectors.floats_to_bytes(F.col("embedding")), F.unhex(F.lit("0102"))).alias("raw"),
    )
    decoded = raw.select("vec_id", vectors.bytes_to_floats(F.col("raw")).alias("vector"))
    return decoded.select("vec_id", F.posexplode("vector").alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


@query(
    """
    SELECT p_partkey, 'DOUBLE' AS size_kind, CAST(p_size AS DOUBLE) AS size,
           'DOUBLE' AS price_kind, p_retailprice AS price,
           'STRING' AS name_kind, p_name AS name,
           'STRING' AS suffixed_kind, p_size || 'd' AS suffixed,
           'STRING' AS padded_kind, ' ' || p_size AS padded,
           'STRING' AS tag_kind, CAST(p_size AS VARCHAR) AS tag
    FROM part
    """
)
def numeric_parse_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """NUMERIC attributes whose text is, or only resembles, a number."""
    size = F.col("p_size").cast("string")
    texts = {
        "size": ("NUMERIC", size, "double"),
        "price": ("NUMERIC", F.col("p_retailprice").cast("string"), "double"),
        "name": ("NUMERIC", F.col("p_name"), "string"),
        "suffixed": ("NUMERIC", F.concat(size, F.lit("d")), "string"),
        "padded": ("NUMERIC", F.concat(F.lit(" "), size), "string"),
        "tag": ("TAG", size, "string"),
    }
    parsed = table(spark, folder, "part").select(
        "p_partkey", *[payload.parse_field(F.lit(k), c).alias(n) for n, (k, c, _) in texts.items()]
    )
    columns = []
    for name, (_, _, data_type) in texts.items():
        columns.append(F.schema_of_variant(name).alias(f"{name}_kind"))
        columns.append(F.variant_get(name, "$", data_type).alias(name))
    return parsed.select("p_partkey", *columns)


@query(
    """
    SELECT o_orderkey, 'BIGINT' AS key_kind, o_orderkey AS key,
           'DOUBLE' AS price_kind, o_totalprice AS price, 'STRING' AS text_kind, o_orderpriority AS text,
           o_custkey AS nested, 'DOUBLE' AS huge_kind
    FROM orders
    """
)
def narrow_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Number text becomes an integer where it fits, lists and objects included."""
    key = F.col("o_orderkey").cast("string")
    record = F.struct(
        key.alias("key"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderpriority").alias("text"),
        F.array(F.create_map(F.lit("c"), F.col("o_custkey").cast("string"))).alias("list"),
        F.concat(F.lit("9223372036854775807"), key).alias("huge"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", record.alias("record"))
    narrowed = payload.narrow_numbers(F.col("record"), orders.schema["record"].dataType)
    values = orders.select("o_orderkey", narrowed.alias("payload"))
    kinds = [
        F.schema_of_variant(field(n, "variant")).alias(f"{n}_kind")
        for n in ("key", "price", "text", "huge")
    ]
    return values.select(
        "o_orderkey",
        *kinds,
        field("key", "bigint").alias("key"),
        field("price", "double").alias("price"),
        field("text", "string").alias("text"),
        field("list[0].c", "bigint").alias("nested"),
    )


@query(
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'BIGINT' AS k_kind,
           event_type AS type, true AS broken_is_null
    FROM events
    """
)
def json_payload(spark: SparkSession, folder: str) -> DataFrame:
    parsed = table(spark, folder, "events").select(
        "event_id",
        "event_type",
        payload.parse_json_object(F.col("props")).alias("payload"),
        payload.parse_json_object(F.expr("substring(props, 2)"), strict=False).alias("broken"),
    )
    return parsed.select(
        "event_id",
        field("k", "bigint").alias("k"),
        F.schema_of_variant(field("k", "variant")).alias("k_kind"),
        F.col("event_type").alias("type"),
        F.col("broken").isNull().alias("broken_is_null"),
    )


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS nested_at,
           CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS amount,
           value, CAST(user_id AS INTEGER) AS user_small, event_type AS from_bytes
    FROM events
    """
)
def sanitize_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Times, decimals and bytes at any depth become payload-safe values."""
    record = F.struct(
        F.col("ts").alias("at"),
        F.struct(F.array("ts").alias("times")).alias("nested"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.col("value"),
        F.col("user_id").cast("int").alias("user_small"),
        F.encode("event_type", "UTF-8").alias("raw"),
    )
    events = table(spark, folder, "events").select("event_id", record.alias("record"))
    clean = payload.sanitize(F.col("record"), events.schema["record"].dataType)
    packed = events.select("event_id", F.to_variant_object(clean).alias("payload"))
    return packed.select(
        "event_id",
        field("at", "string").alias("at"),
        field("nested.times[0]", "string").alias("nested_at"),
        field("amount", "string").alias("amount"),
        field("value", "double").alias("value"),
        field("user_small", "int").alias("user_small"),
        field("raw", "string").alias("from_bytes"),
    )


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS zoneless,
           CAST(floor(epoch(ts)) AS BIGINT) AS zoned_epoch
    FROM events
    """
)
def rfc3339_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Zoneless times as UTC; zoned ones with an offset that names the same instant."""
    instant = F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("Z")))
    zoned = payload.rfc3339(instant)
    return table(spark, folder, "events").select(
        "event_id",
        payload.rfc3339(F.col("ts"), T.TimestampNTZType()).alias("zoneless"),
        F.unix_timestamp(zoned, payload.RFC3339_FORMAT).alias("zoned_epoch"),
    )


@query(
    """
    SELECT doc_id, CASE WHEN lang <> 'es' THEN md5(text) ELSE source END AS document_md5,
           source
    FROM documents
    """
)
def document_field(spark: SparkSession, folder: str) -> DataFrame:
    """Spanish documents have empty text, so the field of that name stays as it was."""
    documents = table(spark, folder, "documents")
    text = F.when(F.col("lang") == "es", "").otherwise(F.col("text"))
    fields = payload.object_fields(
        F.to_variant_object(F.struct(F.col("source").alias("document"), "source"))
    )
    written = documents.select(
        "doc_id",
        "lang",
        payload.pack_fields(payload.with_document(fields, "document", text)).alias("payload"),
    )
    document = field("document", "string")
    return written.select(
        "doc_id",
        F.when(F.col("lang") != "es", F.md5(document)).otherwise(document).alias("document_md5"),
        field("source", "string").alias("source"),
    )


@query(
    """
    SELECT coalesce(reason, 'good') AS reason, count(*) AS records FROM (
      SELECT CASE WHEN event_type = 'error' THEN 'id is missing'
                  WHEN value < 1 THEN 'vector is missing'
                  WHEN props = '{"k": 87}' THEN 'payload is not allowed' END AS reason
      FROM events) GROUP BY ALL
    """
)
def validate_records(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_id")).alias("id"),
        F.when(F.col("value") >= 1, F.array(F.col("value"))).alias("vector"),
        "props",
    )
    rules = [
        Rule("id is missing", F.col("id").isNull()),
        Rule("vector is missing", F.col("vector").isNull()),
        Rule("payload is not allowed", F.col("props") == '{"k": 87}'),
    ]
    return (
        check_records(records, rules, mode="quarantine")
        .groupBy(F.coalesce("reason", F.lit("good")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
