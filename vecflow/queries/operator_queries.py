"""Sinks, catalog, routing and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions import ids
from vecflow.operators import catalog, routing, sink, upsert, verify
from vecflow.operators.collection import StoredCollection
from vecflow.queries.registry import (
    field,
    point_uuid,
    query,
    table,
    uuid5_sql,
    vec_sum,
    vec_sum_sql,
)
from vecflow.schema import COLLECTION, SHARD_KEY, to_points
from vecflow.scratch import scratch_path
from vecflow.sources.relational import from_table

# -- upserts -----------------------------------------------------------------

_REPRICED_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_LAST_PRICE_SQL = f"""
    last_price AS (SELECT l_orderkey, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
        {", ".join(c + " DESC" for c in _REPRICED_ORDER)}) AS nth FROM lineitem) WHERE nth = 1)"""


@query(
    f"""
    WITH {_LAST_PRICE_SQL}
    SELECT o_orderkey, coalesce(l_extendedprice, o_totalprice) AS price
    FROM orders LEFT JOIN last_price ON l_orderkey = o_orderkey
    """
)
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item re-prices its order; the last one stays."""
    target = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    batch = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_extendedprice").alias("price"),
        *_REPRICED_ORDER,
    )
    return upsert.upsert(target, batch, "o_orderkey", _REPRICED_ORDER)


_DOCUMENTS_OVER_VECTORS_SQL = f"""
    SELECT {uuid5_sql("CAST(coalesce(doc_id, vec_id) AS VARCHAR)")} AS id,
           CASE WHEN doc_id IS NULL THEN label ELSE -1 END AS label, md5(text) AS text_md5,
           CASE WHEN doc_id IS NULL THEN {vec_sum_sql("embedding")} ELSE 0 END AS vec_sum
    FROM documents FULL JOIN embeddings ON vec_id = doc_id
"""


def _documents_over_vectors(points: DataFrame) -> DataFrame:
    return points.select(
        point_uuid(),
        F.coalesce(field("label", "int"), F.lit(-1)).alias("label"),
        F.md5(field("text", "string")).alias("text_md5"),
        F.coalesce(vec_sum(F.col("dense")["embedding"]), F.lit(0)).alias("vec_sum"),
    )


@query(_DOCUMENTS_OVER_VECTORS_SQL)
def upsert_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Documents replace vectors of the same id and add the others; done twice, as if once."""
    target = from_table(table(spark, folder, "embeddings"), "vec_id")
    batch = from_table(table(spark, folder, "documents"), "doc_id", carry=["doc_id"])
    once = upsert.upsert(target, batch, "id", "doc_id")
    return _documents_over_vectors(upsert.upsert(once, batch, "id", "doc_id"))


@query(_DOCUMENTS_OVER_VECTORS_SQL)
def upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same through a stored collection and its commits."""
    target = StoredCollection(spark, scratch_path(spark, "collection"), buckets=8)
    documents = from_table(table(spark, folder, "documents"), "doc_id")
    target.upsert(from_table(table(spark, folder, "embeddings"), "vec_id"))
    target.upsert(documents)
    target.upsert(documents)
    return _documents_over_vectors(target.points())


@query("SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def upsert_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's last event stays, though its batch may come before those of earlier ones."""
    target = StoredCollection(spark, scratch_path(spark, "collection"), buckets=8)
    points = to_points(
        table(spark, folder, "events"),
        "event_id",
        "event_type",
        id=ids.numeric_id(F.col("user_id")),
        payload=F.to_variant_object(F.struct("event_id")),
    )
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    for batch in (points.where(clicks), points.where(~clicks)):
        target.upsert(batch, seq="event_id")
    return target.points().select(
        F.col("id.num").cast("bigint").alias("user_id"), field("event_id", "bigint").alias("event_id")
    )


class _CountingClient:
    """Stands in for a target service: takes a batch and checks its size and shape."""

    def upsert(self, rows: list[dict]) -> None:
        if not 0 < len(rows) <= 500 or any(r["id"] is None for r in rows):
            raise ValueError("malformed batch")


@query("SELECT count(*) AS points, CAST(0 AS BIGINT) AS retries FROM orders")
def write_batches(spark: SparkSession, folder: str) -> DataFrame:
    points = from_table(table(spark, folder, "orders"), "o_orderkey")
    return sink.write_batches(points, _CountingClient, batch_size=500).select("points", "retries")


# -- catalog -----------------------------------------------------------------


def _catalog_row(name: Column, method: Column) -> list[Column]:
    types = dict(item.rsplit(" ", 1) for item in COLLECTION.split(", "))
    values = {"name": name, "sharding_method": method}
    return [
        values.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()
    ]


@query(
    """
    SELECT DISTINCT c_mktsegment AS name, 'auto' AS sharding_method FROM customer
    UNION
    SELECT DISTINCT p_type, 'custom' FROM part
    """
)
def ensure_collection(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted collections are added; one that exists keeps its settings."""
    segments = table(spark, folder, "customer").select("c_mktsegment").distinct()
    types = table(spark, folder, "part").select("p_type").distinct()
    existing = segments.select(*_catalog_row(F.col("c_mktsegment"), F.lit("auto")))
    wanted = types.unionByName(segments.select(F.col("c_mktsegment").alias("p_type"))).select(
        *_catalog_row(F.col("p_type"), F.lit("custom"))
    )
    return catalog.ensure_collections(existing, wanted).select("name", "sharding_method")


@query("SELECT 'embedding' AS name, CAST(max(len(embedding)) AS BIGINT) AS dimension FROM embeddings")
def discover_vector_columns(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.discover_vector_columns(table(spark, folder, "embeddings"))


def _mappings(
    customers: DataFrame, kind: str, dims: str, metric: str, metrics: dict[str, str]
) -> DataFrame:
    """One index mapping per customer: a vector field, one without size, and a text field."""
    declared = catalog.lookup(metrics, F.col("c_mktsegment"))
    properties = F.struct(
        F.struct(
            F.lit(kind).alias("type"),
            (F.col("c_nationkey") + 1).alias(dims),
            declared.alias(metric),
        ).alias("vector"),
        F.struct(F.lit(kind).alias("type")).alias("unsized"),
        F.struct(F.lit("text").alias("type")).alias("title"),
    )
    definition = F.struct(F.struct(properties.alias("properties")).alias("mappings"))
    return customers.select(F.to_json(F.create_map("c_name", definition)).alias("mapping"))


_SIMILARITY_BY_SEGMENT = {
    "AUTOMOBILE": "l2_norm",
    "BUILDING": "COSINE",
    "FURNITURE": "max_inner_product",
    "HOUSEHOLD": "hamming",
}


@query(
    """
    SELECT c_name AS collection, 'vector' AS name, CAST(c_nationkey + 1 AS BIGINT) AS size,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'euclid' WHEN 'FURNITURE' THEN 'dot'
                ELSE 'cosine' END AS distance,
           c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') AS defaulted
    FROM customer
    """
)
def es_mapping_params(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    mappings = _mappings(customers, "dense_vector", "dims", "similarity", _SIMILARITY_BY_SEGMENT)
    return catalog.params_from_es_mapping(mappings)


_SPACE_BY_SEGMENT = {
    "AUTOMOBILE": "l2",
    "BUILDING": "CosineSimil",
    "FURNITURE": "innerproduct",
    "HOUSEHOLD": "l1",
}


@query(
    """
    SELECT c_name AS collection, 'vector' AS name, CAST(c_nationkey + 1 AS BIGINT) AS size,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'euclid' WHEN 'FURNITURE' THEN 'dot'
                WHEN 'HOUSEHOLD' THEN 'manhattan' ELSE 'cosine' END AS distance,
           c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') AS defaulted
    FROM customer
    """
)
def os_mapping_params(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    mappings = _mappings(customers, "knn_vector", "dimension", "space_type", _SPACE_BY_SEGMENT)
    return catalog.params_from_os_mapping(mappings)


@query(
    """
    SELECT p_brand AS collection, p_type AS name, CAST(p_size AS BIGINT) AS size, p_partkey,
           CASE p_type WHEN 'ECONOMY' THEN 'dot' WHEN 'LARGE' THEN 'manhattan' ELSE 'cosine' END
             AS distance
    FROM part WHERE p_size > 10
    """
)
def field_params(spark: SparkSession, folder: str) -> DataFrame:
    fields = table(spark, folder, "part").select(
        F.concat_ws("/", "p_brand", F.col("p_partkey").cast("string")).alias("collection"),
        F.col("p_type").alias("name"),
        F.when(F.col("p_size") > 10, "FloatVector").otherwise("VarChar").alias("data_type"),
        F.create_map(F.lit("dim"), F.col("p_size").cast("string")).alias("type_params"),
    )
    params = catalog.params_from_fields(fields, {"ECONOMY": "dot", "LARGE": "manhattan"})
    owner = F.split("collection", "/")
    return params.select(
        owner[0].alias("collection"),
        "name",
        "size",
        owner[1].cast("bigint").alias("p_partkey"),
        "distance",
    )


_SOURCE_SQL = """CASE WHEN c_nationkey < 6 THEN 'pinecone' WHEN c_nationkey < 12 THEN 's3_vectors'
                      WHEN c_nationkey < 18 THEN 'chroma' ELSE 'faiss' END"""
_METRIC_SQL = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'cosine' WHEN 'BUILDING' THEN 'euclidean'
                      WHEN 'FURNITURE' THEN 'euclid' WHEN 'HOUSEHOLD' THEN 'dotproduct' END"""


@query(
    f"""
    WITH d AS (SELECT c_name AS collection, {_SOURCE_SQL} AS source, {_METRIC_SQL} AS metric,
                      c_nationkey FROM customer)
    SELECT collection, source,
      CASE WHEN source = 'pinecone' THEN
             CASE metric WHEN 'cosine' THEN 'cosine' WHEN 'euclidean' THEN 'euclid'
                         WHEN 'dotproduct' THEN 'dot' END
           WHEN source = 's3_vectors' THEN
             CASE metric WHEN 'cosine' THEN 'cosine' WHEN 'euclidean' THEN 'euclid' END
           ELSE CASE WHEN metric IN ('cosine', 'euclid') THEN metric
                     WHEN metric IS NULL AND source = 'chroma' THEN 'euclid'
                     WHEN metric IS NULL THEN 'cosine' END END AS distance,
      CASE WHEN source = 's3_vectors' AND (metric IS NULL OR metric NOT IN ('cosine', 'euclidean'))
           THEN 'no counterpart for the distance ' || coalesce(metric, 'none') END AS problem,
      CAST(c_nationkey + 1 AS BIGINT) AS size
    FROM d
    """
)
def distance_lookup(spark: SparkSession, folder: str) -> DataFrame:
    indexes = table(spark, folder, "customer").select(
        F.col("c_name").alias("collection"),
        F.expr(_SOURCE_SQL).alias("source"),
        F.expr(_METRIC_SQL).alias("metric"),
        (F.col("c_nationkey") + 1).cast("bigint").alias("size"),
    )
    params = catalog.params_single(indexes, strict=False)
    return params.select("collection", "source", "distance", "problem", "size")


_FIELD_TYPE_SQL = """CASE p_type WHEN 'ECONOMY' THEN 'keyword' WHEN 'LARGE' THEN 'integer'
                          WHEN 'MEDIUM' THEN 'datetime' WHEN 'SMALL' THEN 'uuid' ELSE 'blob' END"""


def _schemas(parts: DataFrame) -> DataFrame:
    """One collection per brand whose payload fields are its part types (a handful)."""
    entries = F.struct(F.col("p_type").alias("key"), F.expr(_FIELD_TYPE_SQL).alias("value"))
    return parts.groupBy(F.col("p_brand").alias("name")).agg(
        F.map_from_entries(F.collect_set(entries)).alias("payload_schema")
    )


@query(
    f"""
    SELECT DISTINCT p_brand AS name, p_type AS field, {_FIELD_TYPE_SQL} AS field_type
    FROM part p
    WHERE {_FIELD_TYPE_SQL} <> 'blob' AND NOT EXISTS (
      SELECT 1 FROM part t WHERE t.p_size > 45 AND t.p_brand = p.p_brand AND t.p_type = p.p_type)
    """
)
def payload_index_plan(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    large_only = parts.where(F.col("p_size") > 45)
    return catalog.payload_index_plan(_schemas(parts), _schemas(large_only))


@query(
    """
    SELECT 'copy-' || p_brand AS name, count(DISTINCT p_type) AS vectors,
           CAST(max(p_size) AS BIGINT) AS size, 'custom' AS routed_method, 'auto' AS plain_method,
           CAST(0 AS BIGINT) AS payload_fields
    FROM part GROUP BY p_brand
    """
)
def clone_spec(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    sized = parts.groupBy("p_brand").agg(
        F.collect_set("p_type").alias("types"), F.max("p_size").cast("bigint").alias("size")
    )
    vector_set = F.map_from_entries(
        F.transform(
            "types",
            lambda t: F.struct(
                t.alias("key"),
                F.struct(F.col("size").alias("size"), F.lit("dot").alias("distance")).alias("value"),
            ),
        )
    )
    source = sized.select(
        F.col("p_brand").alias("name"),
        vector_set.alias("vectors"),
        F.array().cast("array<string>").alias("sparse_names"),
        F.create_map(F.lit("f"), F.lit("keyword")).alias("payload_schema"),
        F.lit("auto").alias("sharding_method"),
    )
    target = F.concat(F.lit("copy-"), F.col("name"))
    routed = catalog.check_routable(catalog.clone_spec(source, target, routed=True))
    plain = catalog.clone_spec(source, target).select(
        "name", F.col("sharding_method").alias("plain_method")
    )
    return routed.join(plain, "name").select(
        "name",
        F.size("vectors").cast("bigint").alias("vectors"),
        F.map_values("vectors")[0]["size"].alias("size"),
        F.col("sharding_method").alias("routed_method"),
        "plain_method",
        F.size("payload_schema").cast("bigint").alias("payload_fields"),
    )


@query(
    """
    SELECT CAST(label AS VARCHAR) AS name, 'embedding' AS vector,
           CAST(len(embedding) AS BIGINT) AS found_size,
           CAST(CASE WHEN label < 8 THEN 32 ELSE -1 END AS BIGINT) AS declared_size,
           count(*) AS points
    FROM embeddings WHERE label >= 4 GROUP BY ALL
    """
)
def check_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    """One collection per label: some declared right, some too small, some not at all."""
    rows = table(spark, folder, "embeddings")
    points = rows.select(
        F.col("label").cast("string").alias("name"),
        F.create_map(F.lit("embedding"), F.col("embedding")).alias("dense"),
    )
    size = F.when(F.col("label") < 4, 64).otherwise(32).cast("bigint")
    declared = F.when(
        F.col("label") < 8,
        F.create_map(F.lit("embedding"), F.struct(size.alias("size"), F.lit("dot").alias("distance"))),
    )
    spec = rows.select("label").distinct().select(
        F.col("label").cast("string").alias("name"), declared.alias("vectors")
    )
    return catalog.check_dimensions(points, spec).withColumn(
        "declared_size", F.coalesce("declared_size", F.lit(-1))
    )


# -- routing -----------------------------------------------------------------


def _event_points(spark: SparkSession, folder: str) -> DataFrame:
    """Events as points; the field ``shard`` holds text, numbers and unusable values."""
    events = table(spark, folder, "events")
    shard = (
        F.when(F.col("event_type") == "click", F.col("event_type").cast("variant"))
        .when(F.col("event_type") == "view", F.col("user_id").cast("variant"))
        .when(F.col("event_type") == "error", (-F.col("user_id") - 1).cast("variant"))
        .when(F.col("event_type") == "purchase", F.col("value").cast("variant"))
        .when(F.col("user_id") < 50, F.lit("").cast("variant"))
    )
    return to_points(
        events,
        id=ids.numeric_id(F.col("event_id")),
        payload=F.to_variant_object(F.struct("event_type", "user_id", shard.alias("shard"))),
        shard_key=F.when(
            F.col("event_type") != "view",
            F.struct(F.col("event_type").alias("keyword"), F.lit(None).alias("num")).cast(SHARD_KEY),
        ),
    )


def _numbered(points: DataFrame, *extra: str) -> DataFrame:
    return points.select(
        F.col("id.num").cast("bigint").alias("event_id"),
        F.coalesce("shard_key.keyword", F.lit("none")).alias("keyword"),
        F.coalesce(F.col("shard_key.num").cast("bigint"), F.lit(-1)).alias("number"),
        *[F.coalesce(c, F.lit("none")).alias(c) for c in extra],
    )


@query("SELECT event_id, 'only' AS keyword, CAST(-1 AS BIGINT) AS number FROM events")
def route_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(routing.route(_event_points(spark, folder), fixed="only"))


@query(
    """
    SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type ELSE 'none' END AS keyword,
           CAST(-1 AS BIGINT) AS number FROM events
    """
)
def route_preserve(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(routing.route(_event_points(spark, folder)))


@query("SELECT event_id, 'none' AS keyword, user_id AS number FROM events")
def route_by_field(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(routing.route(_event_points(spark, folder), field="user_id"))


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'click' THEN event_type ELSE 'none' END AS keyword,
           CASE WHEN event_type = 'view' THEN user_id ELSE -1 END AS number,
           CASE WHEN event_type IN ('click', 'view') THEN 'none' ELSE
             'no shard for point ' || event_id || ': field shard '
             || 'holds neither text nor a number from 0 on' END AS reason
    FROM events
    """
)
def route_errors(spark: SparkSession, folder: str) -> DataFrame:
    points = routing.route_by_field(_event_points(spark, folder), "shard", mode="quarantine")
    return _numbered(points, "reason")


@query(
    """
    SELECT CASE WHEN event_type <> 'view' THEN event_type END AS keyword, count(*) AS points
    FROM events GROUP BY 1
    """
)
def shard_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = routing.group_by_shard(_event_points(spark, folder))
    return counts.select(F.col("shard_key.keyword").alias("keyword"), "points")


@query("SELECT DISTINCT user_id AS number FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)")
def new_shard_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Users as shards, of which those sharing a supplier's number exist already."""
    routed = routing.route(_event_points(spark, folder), field="user_id")
    known = table(spark, folder, "supplier").select(
        F.struct(F.lit(None).alias("keyword"), F.col("s_suppkey").alias("num"))
        .cast(SHARD_KEY)
        .alias("shard_key")
    )
    return routing.new_shard_keys(routed, known).select(
        F.col("shard_key.num").cast("bigint").alias("number")
    )


@query(
    """
    SELECT CASE WHEN event_type <> 'view' THEN 'k:' || event_type END AS shard,
           count(*) AS points, CAST(sum(event_id) AS BIGINT) AS id_total
    FROM events GROUP BY 1
    """
)
def write_sharded(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back from the folders, counted per shard."""
    path = scratch_path(spark, "sharded")
    points = _event_points(spark, folder)
    routing.write_sharded(points, path)
    stored = routing.read_sharded(spark, path, points.schema.add("shard", "string"))
    return stored.groupBy("shard").agg(
        F.count(F.lit(1)).alias("points"), F.sum("id.num").cast("bigint").alias("id_total")
    )


# -- verification ------------------------------------------------------------


def _order_points(orders: DataFrame, **changes: Column) -> DataFrame:
    return from_table(orders.withColumns(changes) if changes else orders, "o_orderkey")


@query(
    """
    SELECT o_orderstatus, count(*) AS source_count,
           count(*) FILTER (o_orderpriority <> '1-URGENT' OR o_orderstatus = 'F') AS target_count,
           CASE WHEN o_orderstatus = 'F' OR count(*) FILTER (o_orderpriority = '1-URGENT') = 0
                THEN 'equal' ELSE 'different' END AS status
    FROM orders GROUP BY o_orderstatus
    """
)
def count_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    copied = orders.where((F.col("o_orderpriority") != "1-URGENT") | (F.col("o_orderstatus") == "F"))
    return verify.count_check(orders, copied, "o_orderstatus")


@query("SELECT count(*) AS points FROM lineitem")
def exact_count(spark: SparkSession, folder: str) -> DataFrame:
    return verify.exact_count(table(spark, folder, "lineitem"))


_COMPARED_SQL = """
    compared AS (
      SELECT o_orderkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'missing'
               WHEN '2-HIGH' THEN 'payload_differs' ELSE 'match' END AS status FROM orders
      UNION ALL
      SELECT vec_id, CASE label WHEN 0 THEN 'vector_differs' WHEN 1 THEN 'unexpected'
               ELSE 'match' END FROM embeddings)"""


def _both_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and vectors against a copy in which some were lost, changed or added."""
    orders, rows = table(spark, folder, "orders"), table(spark, folder, "embeddings")
    vector_key = F.concat(F.lit("v"), F.col("vec_id").cast("string"))
    rows = rows.withColumn("vec_id", vector_key)
    priority = F.col("o_orderpriority")
    price = F.col("o_totalprice") + F.when(priority == "2-HIGH", 1).otherwise(0)
    copied_orders = _order_points(orders.where(priority != "1-URGENT"), o_totalprice=price)
    reversed_some = F.when(F.col("label") == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    source = _order_points(orders).unionByName(
        from_table(rows.where(F.col("label") != 1), "vec_id")
    )
    target = copied_orders.unionByName(
        from_table(rows.withColumn("embedding", reversed_some), "vec_id")
    )
    return source, target


@query(f"WITH {_COMPARED_SQL} SELECT status, count(*) AS points FROM compared GROUP BY status")
def reconcile_report(spark: SparkSession, folder: str) -> DataFrame:
    return verify.reconcile_report(*_both_sides(spark, folder))


@query(f"WITH {_COMPARED_SQL} SELECT status, count(*) AS points FROM compared GROUP BY status")
def reconcile_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The same report by sums per bucket, and id by id where these differ."""
    return verify.reconcile_by_buckets(*_both_sides(spark, folder), buckets=512)


@query(
    f"""
    SELECT {uuid5_sql("CAST(o_orderkey AS VARCHAR)")} AS id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'missing' WHEN '2-HIGH' THEN 'payload_differs'
             ELSE 'match' END AS status FROM orders
    UNION ALL
    SELECT {uuid5_sql("'v' || vec_id")}, CASE label WHEN 0 THEN 'vector_differs'
             WHEN 1 THEN 'unexpected' ELSE 'match' END FROM embeddings
    """
)
def reconcile_points(spark: SparkSession, folder: str) -> DataFrame:
    return verify.compare(*_both_sides(spark, folder)).select(point_uuid(), "status")


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'click' THEN 'shard_differs' ELSE 'match' END AS status
    FROM events
    """
)
def reconcile_shards(spark: SparkSession, folder: str) -> DataFrame:
    """A copy that put clicks into another shard."""
    source = _event_points(spark, folder)
    other = F.struct(F.lit("elsewhere").alias("keyword"), F.lit(None).alias("num")).cast(SHARD_KEY)
    is_click = F.col("shard_key.keyword") == "click"
    target = source.withColumn("shard_key", F.when(is_click, other).otherwise(F.col("shard_key")))
    return verify.compare(source, target).select(
        F.col("id.num").cast("bigint").alias("event_id"), "status"
    )


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id,
           CASE label WHEN 0 THEN 'vector_differs' WHEN 1 THEN 'missing' ELSE 'match' END AS status
    FROM embeddings
    """
)
def reconcile_within_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    """A copy that lost digits agrees, one that lost its sign does not."""
    rows = table(spark, folder, "embeddings")
    rounded = F.transform("embedding", lambda x: (x * F.lit(1.001)).cast("float"))
    negated = F.transform("embedding", lambda x: -x)
    copied = rows.where(F.col("label") != 1).withColumn(
        "embedding", F.when(F.col("label") == 0, negated).otherwise(rounded)
    )
    result = verify.compare_within(
        from_table(rows, "vec_id"), from_table(copied, "vec_id"), "embedding", relative=1e-2
    )
    return result.select(point_uuid(), "status")
