"""Ranges, batches, paging and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions import ids, payload
from vecflow.operators import catalog, routing
from vecflow.operators.collection import StoredCollection
from vecflow.operators.sink import ClientTarget
from vecflow.operators.transfer import copy_collection, transfer
from vecflow.plans import progress as tracking
from vecflow.plans import ranges
from vecflow.queries.registry import (
    field,
    point_uuid,
    query,
    table,
    uuid5_sql,
    vec_sum,
    vec_sum_sql,
)
from vecflow.schema import POINT_COLUMNS, to_points
from vecflow.scratch import scratch_path
from vecflow.sources.relational import from_table
from vecflow.streaming.incremental import incremental_upsert, read_new_files

WORKERS = 4
SAMPLES = WORKERS * ranges.SAMPLES_PER_WORKER

_SAMPLE_SQL = f"""
    sample AS (SELECT o_orderkey AS k FROM orders
               ORDER BY md5('seed:' || o_orderkey), o_orderkey LIMIT {SAMPLES})"""
_ALL_RANGES_SQL = f"""{_SAMPLE_SQL},
    ends AS (SELECT k FROM sample UNION ALL SELECT NULL),
    plan AS (SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS range_id,
                    lag(k) OVER w AS start_k, k AS end_k
             FROM ends WINDOW w AS (ORDER BY k NULLS LAST))"""
_IN_PLAN_SQL = "(start_k IS NULL OR k > start_k) AND (end_k IS NULL OR k <= end_k)"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders")


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    return ranges.sample_keys(_orders(spark, folder), "o_orderkey", SAMPLES, "seed")


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    """The plan of all samples, stored once as a copy would do."""
    plan = ranges.ranges_all_samples(_sample(spark, folder), "o_orderkey", "orders", "p1")
    return ranges.save_plan(plan, scratch_path(spark, "plan"))


@query(f"WITH {_SAMPLE_SQL} SELECT k AS o_orderkey FROM sample")
def sample_keys_hash(spark: SparkSession, folder: str) -> DataFrame:
    return _sample(spark, folder)


@query(
    f"""
    WITH {_ALL_RANGES_SQL}
    SELECT 'orders' AS source_key, range_id, CAST(start_k AS VARCHAR) AS start_key,
           CAST(end_k AS VARCHAR) AS end_key FROM plan
    """
)
def ranges_all_samples(spark: SparkSession, folder: str) -> DataFrame:
    return _plan(spark, folder).select("source_key", "range_id", "start_key", "end_key")


@query(
    f"""
    WITH {_SAMPLE_SQL},
    sorted AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS m FROM sample),
    r AS (SELECT CASE WHEN max(m) < {WORKERS} THEN max(m) + 1 ELSE {WORKERS} END AS n FROM sorted),
    ids AS (SELECT unnest(range(0, n)) AS range_id, n FROM r)
    SELECT CAST(range_id AS INTEGER) AS range_id,
           CAST((SELECT k FROM sorted WHERE range_id > 0
                 AND i = (range_id * m) // n) AS VARCHAR) AS start_key,
           CAST((SELECT k FROM sorted WHERE range_id + 1 < n
                 AND i = ((range_id + 1) * m) // n) AS VARCHAR) AS end_key
    FROM ids
    """
)
def ranges_even(spark: SparkSession, folder: str) -> DataFrame:
    plan = ranges.ranges_even(_sample(spark, folder), "o_orderkey", WORKERS, "orders")
    return plan.select("range_id", "start_key", "end_key")


@query(
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 100000 AND o_totalprice <= 250000
    """
)
def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select("o_orderkey", "o_totalprice")
    return orders.where(ranges.in_range(F.col("o_totalprice"), 100000.0, 250000.0))


@query(
    f"""
    WITH {_ALL_RANGES_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, range_id
    FROM (SELECT *, l_orderkey AS k FROM lineitem) JOIN plan ON {_IN_PLAN_SQL}
    """
)
def assign_range(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, whose key repeats, into the ranges planned for orders."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ranges.assign_range(items, "l_orderkey", _plan(spark, folder))


@query(
    f"""
    WITH {_ALL_RANGES_SQL}
    SELECT range_id, count(*) AS points, min(k) AS first_key, max(k) AS last_key
    FROM (SELECT l_orderkey AS k FROM lineitem) JOIN plan ON {_IN_PLAN_SQL}
    GROUP BY range_id
    """
)
def range_stats(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey")
    assigned = ranges.assign_range(items, "l_orderkey", _plan(spark, folder))
    return ranges.range_stats(assigned, "l_orderkey")


@query(
    f"""
    WITH {_ALL_RANGES_SQL}
    SELECT range_id, count(*) AS points, sum(CAST(l_linenumber AS BIGINT))::BIGINT AS lines
    FROM (SELECT *, l_orderkey AS k FROM lineitem) JOIN plan ON {_IN_PLAN_SQL}
    GROUP BY range_id
    """
)
def range_partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    laid_out = ranges.range_partition(items, "l_orderkey", _plan(spark, folder))
    return laid_out.groupBy("range_id").agg(
        F.count(F.lit(1)).alias("points"), F.sum("l_linenumber").alias("lines")
    )


_BATCH = 50
_BATCHED_SQL = f"""
    WITH {_ALL_RANGES_SQL},
    batched AS (SELECT k, range_id,
                  (row_number() OVER (PARTITION BY range_id ORDER BY k) - 1) // {_BATCH} AS batch
                FROM (SELECT o_orderkey AS k FROM orders) JOIN plan ON {_IN_PLAN_SQL})"""


@query(f"{_BATCHED_SQL} SELECT k AS o_orderkey, range_id, CAST(batch AS BIGINT) AS batch FROM batched")
def batch_number(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select("o_orderkey")
    assigned = ranges.assign_range(orders, "o_orderkey", _plan(spark, folder))
    return ranges.batch_number(assigned, "o_orderkey", _BATCH)


@query(
    f"""{_BATCHED_SQL}
    SELECT 'orders' AS source_key, range_id, CAST(batch AS BIGINT) AS batch, count(*) AS points,
           CAST(sum(count(*)) OVER (ORDER BY range_id, batch) AS BIGINT) AS processed
    FROM batched GROUP BY range_id, batch
    """
)
def cumulative_progress(spark: SparkSession, folder: str) -> DataFrame:
    batches = (
        batch_number(spark, folder)
        .groupBy(F.lit("orders").alias("source_key"), "range_id", "batch")
        .agg(F.count(F.lit(1)).alias("points"))
    )
    return tracking.cumulative_progress(batches)


@query("SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100 OFFSET 150")
def offset_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "label")
    return ranges.offset_page(rows, "vec_id", skip=150, n=100)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700 ORDER BY 1 LIMIT 200")
def keyset_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = _orders(spark, folder).select("o_orderkey", "o_custkey")
    return ranges.keyset_page(rows, "o_orderkey", last=700, n=200)


def _user_history(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as progress reports of each user's copy, one range per event type."""
    kinds = F.create_map(
        *[F.lit(x) for pair in zip(_EVENT_TYPES, range(len(_EVENT_TYPES))) for x in pair]
    )
    return table(spark, folder, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("source_key"),
        F.when(F.col("value") < 50, "p1").otherwise("p2").alias("plan_id"),
        F.coalesce(kinds[F.col("event_type")], F.lit(-1)).alias("range_id"),
        F.when(F.col("value") > 5, F.col("event_id").cast("string")).alias("last_key"),
        F.col("event_id").alias("processed"),
        F.to_timestamp_ltz(F.col("ts").cast("string")).alias("updated_at"),
    )


_EVENT_TYPES = ("click", "view", "error")
_HISTORY_SQL = """
    history AS (SELECT 'user-' || user_id AS source_key,
                       CASE WHEN value < 50 THEN 'p1' ELSE 'p2' END AS plan_id,
                       CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'error' THEN 2
                            ELSE -1 END AS range_id,
                       CASE WHEN value > 5 THEN CAST(event_id AS VARCHAR) END AS last_key,
                       event_id AS processed, ts FROM events),
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (
                 PARTITION BY source_key, plan_id, range_id ORDER BY ts DESC, processed DESC) AS nth
               FROM history) WHERE nth = 1 AND last_key IS NOT NULL)"""


@query(
    f"""
    WITH {_HISTORY_SQL}
    SELECT source_key, plan_id, CAST(range_id AS INTEGER) AS range_id, last_key, processed
    FROM latest
    """
)
def progress_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = tracking.latest_progress(_user_history(spark, folder))
    return latest.select("source_key", "plan_id", "range_id", "last_key", "processed")


@query(
    f"""
    WITH {_HISTORY_SQL}
    SELECT source_key, CAST(sum(processed) AS BIGINT) AS processed FROM latest GROUP BY source_key
    """
)
def total_processed(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.total_processed(tracking.latest_progress(_user_history(spark, folder)))


@query(
    f"""
    WITH {_HISTORY_SQL}
    SELECT source_key, plan_id, CAST(range_id AS INTEGER) AS range_id, last_key, processed
    FROM latest WHERE NOT (source_key = 'user-8' AND plan_id = 'p1')
    """
)
def progress_cleared(spark: SparkSession, folder: str) -> DataFrame:
    """A stored history after one plan of one source has been cleared."""
    path = scratch_path(spark, "progress")
    _user_history(spark, folder).write.parquet(path)
    store = tracking.ProgressTable(spark, path)
    store.clear("user-8", "p1")
    return store.load().select("source_key", "plan_id", "range_id", "last_key", "processed")


@query(
    f"""
    WITH {_ALL_RANGES_SQL},
    done AS (SELECT range_id, max(k) AS last_k, count(*) AS n
             FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F')
             JOIN plan ON {_IN_PLAN_SQL} GROUP BY range_id)
    SELECT range_id, CAST(coalesce(last_k, start_k) AS VARCHAR) AS start_key,
           CAST(end_k AS VARCHAR) AS end_key, coalesce(n, 0) AS processed
    FROM plan LEFT JOIN done USING (range_id)
    """
)
def resume_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The plan after the finished orders have been copied."""
    plan = _plan(spark, folder)
    finished = _orders(spark, folder).where(F.col("o_orderstatus") == "F").select("o_orderkey")
    done = (
        ranges.assign_range(finished, "o_orderkey", plan)
        .groupBy(F.lit("orders").alias("source_key"), F.lit("p1").alias("plan_id"), "range_id")
        .agg(
            F.max("o_orderkey").cast("string").alias("last_key"),
            F.count(F.lit(1)).alias("processed"),
        )
    )
    return ranges.resume_ranges(plan, done).select("range_id", "start_key", "end_key", "processed")


def _order_columns(points: DataFrame) -> DataFrame:
    return points.select(
        point_uuid(),
        field("o_orderkey", "bigint").alias("o_orderkey"),
        field("o_totalprice", "double").alias("o_totalprice"),
        field("o_orderpriority", "string").alias("o_orderpriority"),
    )


_ORDER_POINTS_SQL = f"""
    SELECT {uuid5_sql("CAST(o_orderkey AS VARCHAR)")} AS id, o_orderkey, o_totalprice,
           o_orderpriority FROM orders
"""


@query(_ORDER_POINTS_SQL)
def transfer_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A planned copy of all orders into a stored collection, in two jobs."""
    orders = _orders(spark, folder)
    target = StoredCollection(spark, scratch_path(spark, "target"), buckets=8)
    transfer(
        orders,
        "o_orderkey",
        _plan(spark, folder),
        lambda rows: from_table(rows, "o_orderkey", carry=["o_orderkey"]),
        target,
        tracking.ProgressTable(spark, scratch_path(spark, "progress")),
        ranges_per_job=SAMPLES // 2 + 1,
    )
    return _order_columns(target.points())


@query(_ORDER_POINTS_SQL)
def transfer_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """A second copy that starts over, into a new target, after a whole one has left its progress."""
    progress = tracking.ProgressTable(spark, scratch_path(spark, "progress"))
    plan = _plan(spark, folder)
    for restart in (False, True):
        target = StoredCollection(spark, scratch_path(spark, "target"), buckets=8)
        transfer(
            _orders(spark, folder),
            "o_orderkey",
            plan,
            lambda rows: from_table(rows, "o_orderkey", carry=["o_orderkey"]),
            target,
            progress,
            restart=restart,
        )
    return _order_columns(target.points())


@query(
    f"""
    WITH {_SAMPLE_SQL.replace("o_orderkey", "event_id").replace("orders", "events")},
    ends AS (SELECT k FROM sample UNION ALL SELECT NULL),
    plan AS (SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS range_id,
                    lag(k) OVER w AS start_k, k AS end_k
             FROM ends WINDOW w AS (ORDER BY k NULLS LAST))
    SELECT 'range' AS kind, CAST(range_id AS VARCHAR) AS name, count(*) AS points
    FROM (SELECT event_id AS k FROM events) JOIN plan ON {_IN_PLAN_SQL} GROUP BY range_id
    UNION ALL
    SELECT 'shard', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY user_id
    """
)
def transfer_to_client(spark: SparkSession, folder: str) -> DataFrame:
    """Events sent to a client, routed by user: points per range and per shard as recorded."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    sample = ranges.sample_keys(events, "event_id", SAMPLES, "seed")
    plan = ranges.ranges_all_samples(sample, "event_id", "events", "p1")
    plan = ranges.save_plan(plan, scratch_path(spark, "plan"))
    target = ClientTarget(spark, OneShardClient, scratch_path(spark, "sent"), batch_size=100)
    progress = tracking.ProgressTable(spark, scratch_path(spark, "progress"))

    def routed(rows: DataFrame) -> DataFrame:
        return routing.route(from_table(rows, "event_id", carry=["event_id"]), field="user_id")

    transfer(events, "event_id", plan, routed, target, progress, ranges_per_job=SAMPLES // 2 + 1)
    by_range = progress.load().select(
        F.lit("range").alias("kind"), F.col("range_id").cast("string").alias("name"), F.col("processed").alias("points")
    )
    by_shard = target.sent().select(
        F.lit("shard").alias("kind"), F.col("number").cast("string").alias("name"), "points"
    )
    return by_range.unionByName(by_shard)


class OneShardClient:
    """Stands in for a sharded service: refuses batches of unknown or several shards."""

    def __init__(self):
        self.shards = set()

    def create_shard_key(self, key: int | str) -> None:
        self.shards.add(key)

    def upsert(self, rows: list[dict]) -> None:
        keys = {row["shard_key"] for row in rows}
        if len(keys) != 1 or not keys <= self.shards:
            raise ValueError(f"malformed batch for shards {keys}")


@query(
    f"""
    SELECT {uuid5_sql("CAST(vec_id AS VARCHAR)")} AS id, {vec_sum_sql("embedding")} AS vec_sum,
           CAST(0 AS BIGINT) AS still_in_progress
    FROM embeddings
    """
)
def copy_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors copied from the check of sizes to cleared progress."""
    rows = table(spark, folder, "embeddings")
    sizes = catalog.discover_vector_columns(rows)
    params = F.struct(F.col("dimension").alias("size"), F.lit("dot").alias("distance"))
    spec = sizes.select(
        F.lit("copy").alias("name"),
        F.create_map("name", params).alias("vectors"),
        F.array().cast("array<string>").alias("sparse_names"),
    )
    plan = ranges.plan_ranges(rows, "vec_id", WORKERS, "embeddings", "p1", seed="seed")
    target = StoredCollection(spark, scratch_path(spark, "target"), buckets=8)
    progress = tracking.ProgressTable(spark, scratch_path(spark, "progress"))
    copy_collection(
        rows,
        "vec_id",
        ranges.save_plan(plan, scratch_path(spark, "plan")),
        lambda part: from_table(part, "vec_id", carry=["vec_id"]),
        target,
        progress,
        spec,
    )
    return target.points().select(
        point_uuid(),
        vec_sum(F.col("dense")["embedding"]).alias("vec_sum"),
        F.lit(progress.load().count()).cast("bigint").alias("still_in_progress"),
    )


def _bounds_sql(key: str, of: str, grouping: str) -> str:
    """A plan whose bounds are the last keys of each group."""
    return f"""
    ends AS (SELECT DISTINCT max({key}) AS k FROM {of} GROUP BY {grouping} UNION ALL SELECT NULL),
    plan AS (SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS range_id,
                    lag(k) OVER w AS start_k, k AS end_k
             FROM ends WINDOW w AS (ORDER BY k NULLS LAST))"""


@query(
    f"""
    WITH {_bounds_sql("ts", "events", "user_id")}
    SELECT event_id, range_id FROM (SELECT event_id, ts AS k FROM events) JOIN plan ON {_IN_PLAN_SQL}
    """
)
def assign_range_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """Instants into ranges that end at each user's last event."""
    instant = F.to_timestamp_ltz(F.col("ts").cast("string")).alias("at")
    events = table(spark, folder, "events").select("event_id", "user_id", instant)
    plan = ranges.ranges_all_samples(events.groupBy("user_id").agg(F.max("at").alias("at")), "at", "events")
    plan = ranges.save_plan(plan, scratch_path(spark, "plan"))
    return ranges.assign_range_merged(events, "at", plan).select("event_id", "range_id")


@query(
    """
    SELECT o_orderkey, range_id, CAST((row_number() OVER (PARTITION BY range_id ORDER BY o_orderkey) - 1) // 100 AS BIGINT) AS batch
    FROM (SELECT o_orderkey, CAST(o_custkey % 10 = 0 AS INTEGER) AS range_id FROM orders)
    """
)
def batch_number_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of two ranges, one of which holds nine tenths of the orders and is numbered in parts."""
    orders = _orders(spark, folder).select("o_orderkey", (F.col("o_custkey") % 10 == 0).cast("int").alias("range_id"))
    return ranges.batch_number(orders, "o_orderkey", 100, parts=32)


@query(
    f"""
    WITH {_bounds_sql("c_name", "customer", "c_nationkey")}
    SELECT c_custkey, range_id FROM (SELECT c_custkey, c_name AS k FROM customer) JOIN plan ON {_IN_PLAN_SQL}
    """
)
def assign_range_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of bytes into ranges that end at each nation's last one."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", F.encode("c_name", "utf-8").alias("key")
    )
    last = customers.groupBy("c_nationkey").agg(F.max("key").alias("key"))
    plan = ranges.save_plan(ranges.ranges_all_samples(last, "key", "customers"), scratch_path(spark, "plan"))
    return ranges.assign_range(customers, "key", plan).select("c_custkey", "range_id")


@query(_ORDER_POINTS_SQL)
def incremental_final_state(spark: SparkSession, folder: str) -> DataFrame:
    """Orders arriving as files, upserted by a stream that stops when none is left."""
    arrivals = scratch_path(spark, "arrivals")
    orders = _orders(spark, folder)
    orders.repartition(4, "o_orderkey").write.parquet(arrivals)
    target = StoredCollection(spark, scratch_path(spark, "target"), buckets=8)
    stream = incremental_upsert(
        read_new_files(spark, arrivals, orders.schema, files_per_batch=2),
        target,
        scratch_path(spark, "checkpoint"),
        normalise=lambda rows: from_table(rows, "o_orderkey", carry=["o_orderkey"]),
    )
    stream.awaitTermination()
    return _order_columns(target.points())


_MIXED_IDS_SQL = f"""
    mixed AS (SELECT c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN '1' || {uuid5_sql("c_name")}
                     ELSE '0' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') END AS k FROM customer),
    sample AS (SELECT k FROM mixed ORDER BY md5('seed:' || k), k LIMIT {SAMPLES}),
    ends AS (SELECT k FROM sample UNION ALL SELECT NULL),
    plan AS (SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS range_id,
                    lag(k) OVER w AS start_k, k AS end_k
             FROM ends WINDOW w AS (ORDER BY k NULLS LAST))"""


def _mixed_points(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as points, some with number ids and some with UUIDs."""
    as_uuid = F.col("c_mktsegment") == "BUILDING"
    point_id = F.when(as_uuid, ids.uuid_id(ids.uuid5(F.col("c_name")))).otherwise(
        ids.numeric_id(F.col("c_custkey"))
    )
    points = to_points(
        table(spark, folder, "customer"),
        id=point_id,
        payload=payload.pack_columns({"name": F.col("c_name"), "balance": F.col("c_acctbal")}),
    )
    return points.withColumn("id_key", ids.id_sort_key(F.col("id")))


@query(
    f"""
    WITH {_MIXED_IDS_SQL}
    SELECT range_id, count(*) AS points, min(k) AS first_key, max(k) AS last_key
    FROM mixed JOIN plan ON {_IN_PLAN_SQL} GROUP BY range_id
    """
)
def point_id_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges over the ids of a collection that has both kinds."""
    points = _mixed_points(spark, folder)
    plan = ranges.plan_ranges(points, "id_key", WORKERS, "customers", "p1", seed="seed")
    return ranges.range_stats(ranges.assign_range(points, "id_key", plan), "id_key")


@query(
    """
    SELECT c_name AS name, c_acctbal AS balance,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) ELSE 'uuid' END AS n
    FROM customer
    """
)
def transfer_collection(spark: SparkSession, folder: str) -> DataFrame:
    """One stored collection copied to another, by ranges of its ids."""
    source = StoredCollection(spark, scratch_path(spark, "source"), buckets=4)
    source.upsert(_mixed_points(spark, folder).select(*POINT_COLUMNS))
    stored = source.points().withColumn("id_key", ids.id_sort_key(F.col("id")))
    plan = ranges.plan_ranges(stored, "id_key", WORKERS, "customers", "p1")
    target = StoredCollection(spark, scratch_path(spark, "target"), buckets=4)
    transfer(
        stored,
        "id_key",
        ranges.save_plan(plan, scratch_path(spark, "plan")),
        lambda rows: rows.select(*POINT_COLUMNS),
        target,
        tracking.ProgressTable(spark, scratch_path(spark, "progress")),
    )
    return target.points().select(
        field("name", "string").alias("name"),
        field("balance", "double").alias("balance"),
        F.coalesce(F.col("id.num").cast("string"), F.lit("uuid")).alias("n"),
    )
