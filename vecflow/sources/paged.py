"""Any page-by-page source as one Spark partition per key range, with conditions and columns handed to the source.

Spark gives the filters of a query to the source before its partitions are planned. Those on the key narrow the ranges,
so a range that no row can come from is never opened; all of them, and the columns that are read, travel in each
request. A source may answer with more than was asked for: Spark checks the filters again.
"""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringStartsWith,
)

#: ``fetch(start, end, limit)`` returns up to ``limit`` records with
#: ``start < key <= end`` in key order; a null bound is open.
Fetch = Callable[[Any, Any, int], pa.Table]

PUSHDOWN_SETTING = "spark.sql.python.filterPushdown.enabled"


@dataclass(frozen=True)
class PageRequest:
    """What a range asks of a source: its records in key order, in pages of at most ``limit``.

    Records lie after ``start`` (from it on, if ``from_start``) and not after ``end``; a null bound is open. Only
    ``columns`` are used, and only rows for which all ``filters`` hold. ``after`` is the last key below ``start`` that
    is known to belong to no other range, for sources that can only start after a key.
    """

    start: Any
    end: Any
    limit: int
    from_start: bool = False
    columns: tuple[str, ...] = ()
    filters: tuple[Filter, ...] = ()
    after: Any = None


#: Yields the pages of one request. It is called once for a range, so a cursor can stay open.
Pages = Callable[[PageRequest], Iterator[pa.Table]]


@dataclass
class KeyRange(InputPartition):
    range_id: int
    start: Any
    end: Any
    from_start: bool = False
    after: Any = None


@dataclass(frozen=True)
class KeyBounds:
    """What a query's filters say of the key: a lower and an upper bound, and a list of keys; null means nothing."""

    low: Any = None
    with_low: bool = False
    high: Any = None
    keys: tuple | None = None

    @classmethod
    def of(cls, filters: Sequence[Filter], key: str) -> KeyBounds:
        bounds = cls()
        for condition in filters:
            if getattr(condition, "attribute", None) == (key,):
                bounds = bounds.with_filter(condition)
        return bounds

    def with_filter(self, condition: Filter) -> KeyBounds:
        match condition:
            case EqualTo(value=value) | EqualNullSafe(value=value) if ordered(value):
                return self._listed((value,))
            case In(value=values) if all(v is None or ordered(v) for v in values):
                return self._listed(tuple(v for v in values if v is not None))
            case GreaterThan(value=value) if ordered(value):
                return self._above(value, False)
            case GreaterThanOrEqual(value=value) if ordered(value):
                return self._above(value, True)
            case LessThan(value=value) | LessThanOrEqual(value=value) if ordered(value):
                return replace(self, high=value if self.high is None else min(self.high, value))
        return self

    def _above(self, value, included: bool) -> KeyBounds:
        if self.low is None or value > self.low or (value == self.low and not included):
            return replace(self, low=value, with_low=included)
        return self

    def _listed(self, values: tuple) -> KeyBounds:
        return replace(self, keys=tuple(sorted(v for v in values if self.keys is None or v in self.keys)))

    def narrow(self, part: KeyRange) -> KeyRange | None:
        """The part of a range that can hold such keys; null if none can."""
        made = part
        if self.low is not None and (part.start is None or self.low > part.start):
            made = replace(made, start=self.low, from_start=self.with_low)
            made = made if self.with_low else replace(made, after=self.low)
        if self.high is not None and (part.end is None or self.high < part.end):
            made = replace(made, end=self.high)
        if self.keys is not None:
            held = [k for k in self.keys if holds(made, k)]
            if not held:
                return None
            made = replace(made, start=held[0], from_start=True, end=held[-1])
        if made.start is not None and made.end is not None:
            if made.start > made.end or (made.start == made.end and not made.from_start):
                return None
        return made


def ordered(value) -> bool:
    """Whether Python orders values of this kind as Spark does. Timestamps depend on time zones and are left to Spark."""
    if isinstance(value, float):
        return not math.isnan(value)
    return isinstance(value, (int, str, bytes, Decimal, date)) and not isinstance(value, datetime)


def holds(part: KeyRange, key) -> bool:
    after = part.start is None or key > part.start or (part.from_start and key == part.start)
    return after and (part.end is None or key <= part.end)


def pages_of(fetch: Fetch, key: str, delay_seconds: float = 0.0) -> Pages:
    """A source that answers one page at a time: each page starts after the last key of the one before."""

    def pages(request: PageRequest) -> Iterator[pa.Table]:
        last = request.start
        if request.from_start:
            whole = isinstance(last, int) and not isinstance(last, bool)
            last = last - 1 if whole else request.after  # the key before is known for whole numbers only
        while True:
            page = fetch(last, request.end, request.limit)
            if page.num_rows == 0:
                return
            last = page.column(key)[-1].as_py()
            yield page
            if page.num_rows < request.limit:
                return
            if delay_seconds:
                time.sleep(delay_seconds)

    return pages


class PagedReader(DataSourceReader):
    def __init__(self, pages: Pages, key: str, ranges: Sequence[KeyRange], limit: int, columns: Sequence[str]):
        self.pages, self.key, self.ranges = pages, key, list(ranges)
        self.limit, self.columns, self.filters = limit, tuple(columns), ()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.filters = tuple(filters)
        yield from filters  # Spark applies them too, so a source need not understand them

    def partitions(self) -> list[KeyRange]:
        bounds = KeyBounds.of(self.filters, self.key)
        narrowed = [bounds.narrow(part) for part in self.ranges]
        return [part for part in narrowed if part is not None]

    def read(self, part: KeyRange | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no range is left
            return
        request = PageRequest(part.start, part.end, self.limit, part.from_start, self.columns, self.filters, part.after)
        for page in self.pages(request):
            yield from page.select(list(self.columns)).combine_chunks().to_batches()


def ranged_source(
    spark: SparkSession,
    pages: Pages,
    plan: Sequence[Row],
    key: str,
    schema: str,
    batch_size: int = 50,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read ``plan``'s ranges from a source that yields the pages of a range, each range in its own task.

    ``plan`` rows carry ``range_id``, ``start_key`` and ``end_key`` in the key's own type. ``columns`` (all of
    ``schema`` by default) are those the source is asked for: Spark tells a Python source which filters a query has,
    but not which columns, so name them here. The key need not be among them. A lost task starts its range again, which
    is safe because a scan has no effect on the source. The session's setting for filters of Python sources is turned
    on.
    """
    if batch_size < 1:
        raise ValueError(f"pages of {batch_size} records: the number must be greater than 0")
    declared = T.StructType.fromDDL(schema)
    names = declared.names if columns is None else list(columns)
    unknown = [c for c in names if c not in declared.names]
    if unknown:
        raise ValueError(f"columns outside the schema: {unknown}")
    shape = T.StructType([declared[c] for c in names])
    ranges = [KeyRange(r["range_id"], r["start_key"], r["end_key"], after=r["start_key"]) for r in plan]
    reader = PagedReader(pages, key, ranges, batch_size, names)

    # Every source has its own name, so an earlier one keeps its own pages.
    format_name = f"vecflow_paged_{uuid.uuid4().hex}"

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self) -> T.StructType:
            return shape

        def reader(self, schema) -> PagedReader:
            return reader

    spark.conf.set(PUSHDOWN_SETTING, "true")
    spark.dataSource.register(PagedSource)
    return spark.read.format(format_name).load()


def paged_source(
    spark: SparkSession,
    fetch: Fetch,
    plan: Sequence[Row],
    key: str,
    schema: str,
    batch_size: int = 50,
    delay_seconds: float = 0.0,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``ranged_source`` for a source that answers one page at a time through an injected ``fetch``."""
    return ranged_source(spark, pages_of(fetch, key, delay_seconds), plan, key, schema, batch_size, columns)


# -- requests in a source's own language ---------------------------------------


def arrow_condition(request: PageRequest, key: str) -> pc.Expression:
    """The request's bounds and those of its filters that Arrow can express, for a dataset scan."""
    field = pc.field(key)
    condition = field.is_valid()
    if request.start is not None:
        condition &= field >= request.start if request.from_start else field > request.start
    if request.end is not None:
        condition &= field <= request.end
    for part in (_arrow(f) for f in request.filters):
        if part is not None:
            condition &= part
    return condition


def _arrow(condition: Filter) -> pc.Expression | None:
    if isinstance(condition, Not):
        inner = _arrow(condition.child)
        return None if inner is None else ~inner
    if isinstance(getattr(condition, "value", None), float) and math.isnan(condition.value):
        return None
    column = pc.field(*condition.attribute)
    match condition:
        case EqualTo(value=value):
            return column == value
        case GreaterThan(value=value):
            return column > value
        case GreaterThanOrEqual(value=value):
            return column >= value
        case LessThan(value=value):
            return column < value
        case LessThanOrEqual(value=value):
            return column <= value
        case In(value=values):
            return column.isin([v for v in values if v is not None])
        case IsNull():
            return column.is_null()
        case IsNotNull():
            return column.is_valid()
        case StringStartsWith(value=value):
            return pc.starts_with(column, value)
    return None


def sql_condition(request: PageRequest, key: str, quote: str = '"') -> str:
    """The request's bounds and those of its filters that plain SQL can express, for a database's WHERE."""
    name = sql_name(key, quote)
    parts = []
    if request.start is not None:
        parts.append(f"{name} {'>=' if request.from_start else '>'} {sql_literal(request.start)}")
    if request.end is not None:
        parts.append(f"{name} <= {sql_literal(request.end)}")
    parts += [part for part in (_sql(f, quote) for f in request.filters) if part]
    return " AND ".join(parts) or "1 = 1"


def sql_name(name: str, quote: str) -> str:
    return quote + name.replace(quote, quote * 2) + quote


def sql_literal(value) -> str:
    """A value as SQL text. Timestamps and bytes have none that all databases read alike, and are refused."""
    if isinstance(value, (bytes, bytearray, datetime)) or value is None:
        raise TypeError(f"no portable SQL literal for a value of type {type(value).__name__}")
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


_SQL_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _sql(condition: Filter, quote: str) -> str | None:
    """A filter as SQL; null for one that Spark must check alone."""
    if isinstance(condition, Not):
        inner = _sql(condition.child, quote)
        return inner and f"NOT ({inner})"
    if len(condition.attribute) != 1:
        return None
    name = sql_name(condition.attribute[0], quote)
    if isinstance(condition, IsNull):
        return f"{name} IS NULL"
    if isinstance(condition, IsNotNull):
        return f"{name} IS NOT NULL"
    try:
        if type(condition) in _SQL_SIGNS:
            return None if _not_a_number(condition.value) else f"{name} {_SQL_SIGNS[type(condition)]} {sql_literal(condition.value)}"
        if isinstance(condition, In):
            values = [v for v in condition.value if v is not None]
            return None if any(map(_not_a_number, values)) or not values else f"{name} IN ({', '.join(map(sql_literal, values))})"
    except TypeError:
        return None
    return None


def _not_a_number(value) -> bool:
    return isinstance(value, float) and not math.isfinite(value)
