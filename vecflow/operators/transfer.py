"""A whole copy: ranges of a source, upserted, recorded and checked."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.operators.catalog import check_dimensions, check_routable
from vecflow.operators.collection import StoredCollection
from vecflow.operators.sink import ClientTarget
from vecflow.plans.progress import ProgressTable
from vecflow.plans.ranges import (
    assign_range,
    constant_array,
    in_range,
    key_as_text,
    key_from_text,
    key_literal,
    plain_key,
    plain_type,
    range_index,
    resume_ranges,
)
from vecflow.schema import KEY_MARK, POINT_COLUMNS, RANGE_MARK


def transfer(
    source: DataFrame,
    key: str,
    plan: DataFrame,
    normalise: Callable[[DataFrame], DataFrame],
    target: StoredCollection | ClientTarget,
    progress: ProgressTable,
    ranges_per_job: int | None = None,
    restart: bool = False,
) -> int:
    """Copy every unfinished range of ``plan`` into ``target``; returns points written.

    ``normalise`` makes points of source rows, routed to their shards if need be.
    If it keeps the key column beside the point's own (see ``carry`` of the
    readers; the key must not be named like a point's column), the source is read once: what each range reached is found in the
    write itself. A client then also gets one task per range, and ranges that
    ended before a failure are not sent again. Otherwise the last key of each
    range is found first, from the key column alone, and the job copies up to it.
    Either way progress never speaks of a key that the copy has not read.

    By default one job copies them all: Spark repeats lost tasks by itself.
    ``ranges_per_job`` makes several jobs with progress between them. That pays
    where key bounds spare a job most of the scan, as in a database or files
    sorted by key; the outer bounds are plain predicates that reach the scan.

    Data is committed before progress, and an upsert repeated after a crash
    changes nothing. A null key is an error.
    """
    if ranges_per_job is not None and ranges_per_job < 1:
        raise ValueError("ranges_per_job must be positive")
    data_type = source.schema[key].dataType
    if restart:  # an interrupted restart must not fall back on what an earlier copy had reached
        for plan_key in plan.select("source_key", "plan_id").distinct().collect():
            progress.clear(plan_key["source_key"], plan_key["plan_id"])
    start, end = (key_from_text(F.col(c), data_type) for c in ("start_key", "end_key"))
    unfinished = F.coalesce(start < end, F.lit(True)).alias("unfinished")
    state = resume_ranges(plan, progress.load(restart)).select("*", unfinished)
    resumed = [r.asDict() for r in state.orderBy("range_id").collect()]
    ends = [r["end_key"] for r in resumed if r["end_key"] is not None]
    pending = [r for r in resumed if r["unfinished"]]
    written, step = 0, ranges_per_job or max(1, len(pending))
    carried = key not in POINT_COLUMNS and key in normalise(source).columns

    def record(job: list[dict], reached: dict[int, tuple[str, int]]) -> None:
        done = [
            (r["source_key"], r["plan_id"], r["range_id"], last, r["processed"] + count)
            for r in job
            for last, count in [reached.get(r["range_id"], (None, 0))]
            if count
        ]
        if done:
            columns = "source_key string, plan_id string, range_id int, last_key string, processed bigint"
            progress.store(source.sparkSession.createDataFrame(done, columns))

    for first in range(0, len(pending), step):
        job = pending[first : first + step]
        mine = wanted(F.col(key), ends, job, data_type)
        if first == 0:  # no range holds a null key, so the first job looks for them
            mine = mine | F.col(key).isNull()
        if carried:
            target.marks = {}
            try:
                points = marked(normalise(source.where(mine)), key, ends, data_type)
                options = {"ranges": len(job)} if isinstance(target, ClientTarget) else {}
                written += target.upsert(points, **options)
            finally:
                record(job, target.marks)
            continue
        reached = last_keys(source.select(key).where(mine), key, plan)
        ended = [{**r, "end_key": reached[r["range_id"]][0]} for r in job if r["range_id"] in reached]
        if ended:
            written += target.upsert(normalise(source.where(wanted(F.col(key), ends, ended, data_type))))
            record(job, reached)
    return written


def marked(points: DataFrame, key: str, ends: Sequence[str], data_type: T.DataType) -> DataFrame:
    """Points with the marks of a copy, made of the key column they carry. A null key is an error."""
    plain, bound_type = plain_key(F.col(key), data_type), plain_type(data_type)
    missing = F.raise_error(F.lit(f"missing key in column {key}")).cast(bound_type)
    return points.withColumns(
        {RANGE_MARK: range_index(plain, ends, bound_type).cast("int"), KEY_MARK: F.coalesce(plain, missing)}
    ).drop(key)


def copy_collection(
    source: DataFrame,
    key: str,
    plan: DataFrame,
    normalise: Callable[[DataFrame], DataFrame],
    target: StoredCollection | ClientTarget,
    progress: ProgressTable,
    spec: DataFrame,
    routed: bool = False,
    ranges_per_job: int | None = None,
    restart: bool = False,
) -> tuple[int, int]:
    """A copy from its checks to its end; returns the counts of source and target.

    ``spec`` is the target's catalog row, as ``ensure_collections`` gives it. Vector
    names and sizes of all points, and with ``routed`` the sharding method, are
    checked before anything is written. Progress is forgotten once the counts
    agree; otherwise it stays, so that a later call goes on.
    """
    name = spec.select("name").first()
    if name is None:
        raise ValueError("the target collection does not exist")
    if routed:
        check_routable(spec).collect()  # the target's one row
    named = normalise(source).withColumn("name", F.lit(name["name"]))
    wrong = check_dimensions(named, spec).first()
    if wrong:
        raise ValueError(
            f"vector {wrong['vector']!r} of {wrong['points']} points has size {wrong['found_size']}, "
            f"the target's is {wrong['declared_size']}"
        )
    transfer(source, key, plan, normalise, target, progress, ranges_per_job, restart)
    held = target.count() if isinstance(target, ClientTarget) else target.points().count()
    counts = source.count(), held
    if counts[0] == counts[1]:
        for row in plan.select("source_key", "plan_id").distinct().collect():
            progress.clear(row["source_key"], row["plan_id"])
    return counts


def wanted(key: Column, ends: Sequence[str], job: Sequence[dict], data_type: T.DataType) -> Column:
    """Whether a key lies in one of the job's ranges, by their own start and end.

    ``ends`` are the plan's inner bounds, and every bound is the text it was stored
    as. A row looks its range up by binary search, so the expression stays small
    for any number of ranges; one outer pair of bounds is for the scan to use.
    """
    plain, bound_type = plain_key(key, data_type), plain_type(data_type)
    index, by_range = range_index(plain, ends, bound_type), {r["range_id"]: r for r in job}
    places = range(len(ends) + 1)

    def looked_up(values: list, value_type: T.DataType) -> Column:
        return F.get(constant_array(values, value_type), index)

    start = looked_up([by_range.get(i, {}).get("start_key") for i in places], bound_type)
    end = looked_up([by_range.get(i, {}).get("end_key") for i in places], bound_type)
    outer = [
        None if text is None else key_literal(text, data_type)
        for text in (job[0]["start_key"], job[-1]["end_key"])
    ]
    return (
        key.isNotNull()
        & in_range(key, *outer)
        & looked_up([i in by_range for i in places], T.BooleanType())
        & (start.isNull() | (plain > start))
        & (end.isNull() | (plain <= end))
    )


def last_keys(keys: DataFrame, key: str, plan: DataFrame) -> dict[int, tuple[str, int]]:
    """Text of the last key and number of rows per range: a row per range, at most ten per worker."""
    data_type = keys.schema[key].dataType
    found = (
        assign_range(keys, key, plan)
        .groupBy("range_id")
        .agg(
            key_as_text(F.max(key), data_type).alias("last_key"),
            F.count(F.lit(1)).alias("points"),
            F.count_if(F.col(key).isNull()).alias("nulls"),
        )
        .collect()
    )
    if any(r["nulls"] for r in found):
        raise ValueError(f"missing key in column {key}")
    return {r["range_id"]: (r["last_key"], r["points"]) for r in found}
