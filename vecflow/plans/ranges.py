"""Key ranges: sampled, planned once, stored, and assigned to rows.

A plan is a small table, at most ten ranges per worker. It is kept under a
``plan_id`` so that stored progress always refers to the ranges it was made for.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.schema import RANGE_PLAN

# Fixed value: how many sampled keys each worker gets.
SAMPLES_PER_WORKER = 10


def sample_rank(key: Column, seed: str) -> Column:
    """Position of a key in a seeded random order that any engine can repeat."""
    return F.md5(F.concat(F.lit(seed), F.lit(":"), key.cast("string")))


def sample_keys(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """Exactly ``n`` distinct keys (all of them if fewer), uniform without replacement, sorted.

    A key that many rows repeat counts once. Only ranks under a threshold expected
    to pass a few more than ``n`` keys reach the final top-n, so its input does not
    grow with the number of scan tasks. If too few pass, the threshold is doubled.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    total = keys.agg(F.approx_count_distinct(key)).first()[0]
    ranked = keys.withColumn("_rank", sample_rank(F.col(key), seed))
    candidates = ranked.distinct()
    # The estimate of distinct keys is a few percent off, hence the margin.
    fraction = 1.2 * (n + 10 * math.sqrt(n) + 20) / max(total, 1)
    while fraction < 1:
        candidates = ranked.where(F.col("_rank") <= f"{int(fraction * 16**12):012x}").distinct()
        if candidates.count() >= n:
            break
        candidates, fraction = ranked.distinct(), fraction * 2
    return candidates.orderBy("_rank", key).limit(n).select(key).orderBy(key)


# -- keys as stored text -----------------------------------------------------
#
# Bounds are kept as text, and no bound becomes a Python value on its way back.
# Timestamps are compared and stored as microseconds and bytes as hexadecimal
# digits: both keep the order and every bit, whatever the time zones are.


def plain_key(key: Column, data_type: T.DataType) -> Column:
    """The key in a type whose text form loses nothing, in the same order."""
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(key)
    if isinstance(data_type, T.BinaryType):
        return F.hex(key)
    return key


def plain_type(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.TimestampType):
        return T.LongType()
    return T.StringType() if isinstance(data_type, T.BinaryType) else data_type


def key_as_text(key: Column, data_type: T.DataType) -> Column:
    return plain_key(key, data_type).cast("string")


def key_from_text(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    if isinstance(data_type, T.BinaryType):
        return F.unhex(text)
    return text.cast(data_type)


def key_literal(text: str, data_type: T.DataType) -> Column:
    """A stored bound as a constant that the optimizer folds and the scan can use."""
    return key_from_text(F.lit(text), data_type)


def sample_size(workers: int, total: int) -> int:
    return min(workers * SAMPLES_PER_WORKER, total)


def ranges_all_samples(
    sample: DataFrame, key: str, source_key: str, plan_id: str = "plan"
) -> DataFrame:
    """m sorted samples to m + 1 ranges ``(start, end]``, open at both outer ends.

    The window runs over the sample alone, a few rows per worker.
    """
    ends, data_type = sample.select(F.col(key).alias("_end")).distinct(), sample.schema[key].dataType
    open_end = sample.sparkSession.range(1).select(F.lit(None).cast(data_type).alias("_end"))
    in_order = Window.orderBy(F.col("_end").asc_nulls_last())
    return ends.unionByName(open_end).select(
        F.lit(source_key).alias("source_key"),
        F.lit(plan_id).alias("plan_id"),
        (F.row_number().over(in_order) - 1).alias("range_id"),
        F.lag(key_as_text(F.col("_end"), data_type)).over(in_order).alias("start_key"),
        key_as_text(F.col("_end"), data_type).alias("end_key"),
    )


def ranges_even(
    sample: DataFrame, key: str, workers: int, source_key: str, plan_id: str = "plan"
) -> DataFrame:
    """One range per worker, bounds at even steps through the sorted sample.

    With fewer samples than workers there is one range more than samples; with
    none, a single open range.
    """
    if workers < 1:
        raise ValueError("workers must be positive")
    keys = sample.agg(F.sort_array(F.collect_list(key)).alias("_keys"))
    m = F.size("_keys")
    ranges = F.when(m == 0, 1).when(m < workers, m + 1).otherwise(workers)
    counted = keys.select("_keys", m.alias("_m"), ranges.alias("_r"))
    rows = counted.withColumn("range_id", F.explode(F.sequence(F.lit(0), F.col("_r") - 1)))

    data_type = sample.schema[key].dataType

    def bound(i: Column) -> Column:
        at = F.floor(i * F.col("_m") / F.col("_r")).cast("int")
        inner = (i > 0) & (i < F.col("_r"))
        return F.when(inner, key_as_text(F.get(F.col("_keys"), at), data_type))

    return rows.select(
        F.lit(source_key).alias("source_key"),
        F.lit(plan_id).alias("plan_id"),
        "range_id",
        bound(F.col("range_id")).alias("start_key"),
        bound(F.col("range_id") + 1).alias("end_key"),
    )


def plan_ranges(
    df: DataFrame,
    key: str,
    workers: int,
    source_key: str,
    plan_id: str,
    even: bool = False,
    seed: str = "",
) -> DataFrame:
    """Sample ``df`` and plan its ranges in one of the two shapes."""
    sample = sample_keys(df, key, workers * SAMPLES_PER_WORKER, seed)
    if even:
        return ranges_even(sample, key, workers, source_key, plan_id)
    return ranges_all_samples(sample, key, source_key, plan_id)


def save_plan(plan: DataFrame, path: str) -> DataFrame:
    """Store a plan; what is planned later from the same folder is read, not re-sampled."""
    plan.coalesce(1).write.mode("error").parquet(path)
    return load_plan(plan, path)


def load_plan(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(RANGE_PLAN).parquet(path)


def in_range(key: Column, start, end) -> Column:
    """``start < key <= end`` in the key's own type; a null bound is open."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (key > F.lit(start))
    if end is not None:
        condition = condition & (key <= F.lit(end))
    return condition


def plan_rows(plan: DataFrame, data_type: str | T.DataType) -> list[Row]:
    """The plan on the driver, in range order, bounds in the key's own type.

    For clients that take Python values; a copy inside Spark uses the stored text.
    """
    if isinstance(data_type, str):
        data_type = T.DataType.fromDDL(data_type)
    return (
        plan.select(
            "range_id",
            key_from_text(F.col("start_key"), data_type).alias("start_key"),
            key_from_text(F.col("end_key"), data_type).alias("end_key"),
        )
        .orderBy("range_id")
        .collect()
    )


def plan_predicates(rows: Sequence[Row], column: str, quote: str = '"') -> list[str]:
    """SQL range conditions, one per range, for a JDBC read.

    The first one takes rows without a key too, so that a copy meets and refuses
    them. Numbers, text and dates are written as literals; timestamps and bytes
    have none that all databases read alike, so they are refused.
    """
    name = quote + column.replace(quote, quote * 2) + quote

    def literal(value) -> str:
        if isinstance(value, (bytes, bytearray, datetime)):
            raise TypeError(f"no portable SQL literal for a key of type {type(value).__name__}")
        if isinstance(value, (int, float, Decimal)):
            return str(value)
        return "'" + str(value).replace("'", "''") + "'"

    predicates = []
    for i, row in enumerate(rows):
        parts = []
        if row["start_key"] is not None:
            parts.append(f"{name} > {literal(row['start_key'])}")
        if row["end_key"] is not None:
            parts.append(f"{name} <= {literal(row['end_key'])}")
        condition = " AND ".join(parts) or "1 = 1"
        predicates.append(f"{condition} OR {name} IS NULL" if i == 0 and parts else condition)
    return predicates


def constant_array(values: Sequence, data_type: T.DataType) -> Column:
    """Any number of values as one constant, folded by the optimizer."""
    text = json.dumps([None if v is None else str(v) for v in values])
    return F.from_json(F.lit(text), "array<string>").cast(T.ArrayType(data_type))


def range_index(key: Column, bounds: Sequence, data_type: T.DataType) -> Column:
    """How many of the sorted ``bounds`` (as text) lie below ``key``: the index of its range.

    A binary search over one constant array, so a row costs log2(ranges)
    comparisons and no join is needed.
    """
    if not bounds:
        return F.lit(0)
    array = constant_array(bounds, data_type)
    steps = [2**i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda below, step: F.when(F.get(array, below + step - 1) < key, below + step).otherwise(
            below
        ),
    )


def assign_range(points: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """Add the ``range_id`` each row's key falls into."""
    data_type = points.schema[key].dataType
    inner = plan.select("range_id", "end_key").where(F.col("end_key").isNotNull())
    bounds = [r["end_key"] for r in inner.orderBy("range_id").collect()]
    index = range_index(plain_key(F.col(key), data_type), bounds, plain_type(data_type))
    return points.withColumn("range_id", index)


#: Cells that a large plan is cut into; their lower bounds and sizes are all that reaches the driver.
CELLS = 1024
#: Parts that the rows are spread over at least, so that a cell with many rows is several tasks.
SPREAD = 512


def assign_range_merged(
    points: DataFrame, key: str, plan: DataFrame, cells: int = CELLS, spread: int = SPREAD
) -> DataFrame:
    """``assign_range`` for a plan of any size: keys and bounds are sorted together and merged.

    The plan is cut into cells of equally many ranges. A row finds its cell among their bounds, a constant of at most
    ``cells`` values; inside a cell, rows and bounds are put in key order, and the last bound before a row says which
    range it lies in. A cell knows the number of its first range, so nothing is carried from one cell to the next. A
    cell that holds much of the rows (one key may) is dealt to several tasks, each with all bounds of the cell.
    """
    data_type = points.schema[key].dataType
    bound_type = plain_type(data_type)
    ranges = plan.count()
    size = max(1, -(-ranges // cells))
    first = plan.where(F.col("range_id") % size == 0).where("range_id > 0").select("range_id", "start_key")
    starts = [r["start_key"] for r in first.orderBy("range_id").collect()]
    plain = plain_key(F.col(key), data_type)
    located = points.withColumns({"_plain": plain, "_cell": F.coalesce(range_index(plain, starts, bound_type), F.lit(0))})

    counts = {r["_cell"]: r["count"] for r in located.groupBy("_cell").count().collect()}
    share = max(1, sum(counts.values()) // spread)
    parts = [max(1, -(-counts.get(i, 0) // share)) for i in range(len(starts) + 1)]
    of_cell = F.get(constant_array(parts, T.IntegerType()), F.col("_cell"))
    dealt = located.withColumn("_part", F.pmod(F.monotonically_increasing_id(), of_cell).cast("int"))

    bounds = plan.where(F.col("end_key").isNotNull()).select(
        F.col("end_key").cast(bound_type).alias("_plain"),
        F.floor(F.col("range_id") / size).cast("int").alias("_cell"),
        F.col("range_id").alias("_bound"),
    )
    copies = F.sequence(F.lit(0), of_cell - 1)
    bounds = bounds.withColumn("_part", F.explode(copies))
    both = dealt.withColumn("_bound", F.lit(None).cast("int")).unionByName(bounds, allowMissingColumns=True)
    # A bound ends its range and belongs to it, so at equal keys the rows come first. Null keys lie below all bounds.
    in_order = (
        Window.partitionBy("_cell", "_part")
        .orderBy(F.col("_plain").asc_nulls_first(), F.col("_bound").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    below = F.last("_bound", ignorenulls=True).over(in_order)
    found = both.withColumn("_below", below).where(F.col("_bound").isNull())
    range_id = F.coalesce(F.col("_below") + 1, F.col("_cell") * size).cast("int")
    return found.withColumn("range_id", range_id).select(*points.columns, "range_id")


def range_partition(points: DataFrame, key: str, plan: DataFrame) -> DataFrame:
    """Rows laid out so that a task holds rows of few ranges.

    A rebalance, not a plain repartition: a range holding far more than its share
    (one hot key, stale samples) is split over several tasks.
    """
    return assign_range(points, key, plan).hint("rebalance", "range_id")


def range_stats(points: DataFrame, key: str) -> DataFrame:
    """Rows, first and last key per range; only one row per task and range is shuffled."""
    return points.groupBy("range_id").agg(
        F.count(F.lit(1)).alias("points"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
    )


def batch_number(points: DataFrame, key: str, n: int, parts: int | None = None) -> DataFrame:
    """Number consecutive batches of at most ``n`` points in key order within a range.

    Keys are unique in a collection, so a range stays as large as the plan made it. Where one range can hold much of the
    rows, ``parts`` says into how many parts the keys are cut (by sampled keys): the parts of a range are numbered
    apart, and each goes on from the number of rows in the parts before it. Two narrow passes over the keys find these.
    """
    if n < 1:
        raise ValueError(f"batches of {n} points: the size must be greater than 0")
    if parts is not None and parts < 1:
        raise ValueError("the keys must be cut into one part at least")
    if parts is None:
        row = F.row_number().over(Window.partitionBy("range_id").orderBy(key))
        return points.withColumn("batch", F.floor((row - 1) / n).cast("bigint"))
    data_type = points.schema[key].dataType
    sample = [r[0] for r in sample_keys(points, key, parts * SAMPLES_PER_WORKER).select(key_as_text(F.col(key), data_type)).collect()]
    bounds = [sample[i * len(sample) // parts] for i in range(1, parts)] if len(sample) >= parts else sample
    part = range_index(plain_key(F.col(key), data_type), bounds, plain_type(data_type))
    cut = points.withColumn("_part", F.coalesce(part, F.lit(0)))
    before = F.sum("_rows").over(
        Window.partitionBy("range_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    # A row for each range and part that meet: ranges and parts are both cuts of the keys, so their numbers add up.
    offsets = cut.groupBy("range_id", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = offsets.select("range_id", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    row = F.row_number().over(Window.partitionBy("range_id", "_part").orderBy(key))
    numbered = cut.withColumn("_row", row).join(offsets, ["range_id", "_part"])
    batch = F.floor((F.col("_before") + F.col("_row") - 1) / n).cast("bigint")
    return numbered.withColumn("batch", batch).select(*points.columns, "batch")


def resume_ranges(plan: DataFrame, progress: DataFrame) -> DataFrame:
    """Each range of a plan from where its own progress left off."""
    keys = ["source_key", "plan_id", "range_id"]
    done = progress.select(*keys, "last_key", "processed")
    return plan.join(done, keys, "left").select(
        *keys,
        F.coalesce("last_key", "start_key").alias("start_key"),
        "end_key",
        F.coalesce("processed", F.lit(0).cast("bigint")).alias("processed"),
    )


def keyset_page(df: DataFrame, key: str, last, n: int) -> DataFrame:
    """The next ``n`` rows after ``last`` in key order."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(n)


def offset_page(df: DataFrame, key: str, skip: int, n: int) -> DataFrame:
    """``n`` rows in key order after the first ``skip``."""
    return df.orderBy(key).offset(skip).limit(n)
