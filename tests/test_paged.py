"""What reaches a paged source: ranges, conditions and columns, in the calls it records."""

import json
import sys
import uuid
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pyarrow as pa
import pyarrow.dataset as pads
import pytest
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, IsNull, LessThanOrEqual, Not, StringContains

from vecflow.sources.paged import (
    KeyBounds,
    KeyRange,
    PageRequest,
    arrow_condition,
    paged_source,
    ranged_source,
    sql_condition,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not import tests

SCHEMA = "k bigint, v string, w double"
PLAN = [Row(range_id=i, start_key=s, end_key=e) for i, (s, e) in enumerate([(None, 10), (10, 20), (20, 30), (30, None)])]
KEYS = list(range(0, 40))


class Recorder:
    """A store that notes each request it gets, and answers it in pages."""

    def __init__(self, folder):
        self.folder = str(folder)

    def note(self, name, **values):
        with open(f"{self.folder}/{name}-{uuid.uuid4()}.json", "w") as out:
            json.dump(values, out, default=str)

    def __call__(self, request):
        rows = pa.table({"k": KEYS, "v": [f"v{k % 3}" for k in KEYS], "w": [k / 2 for k in KEYS]})
        found = pads.dataset(rows).to_table(filter=arrow_condition(request, "k"))
        self.note("open", start=request.start, end=request.end, columns=request.columns, filters=len(request.filters), rows=found.num_rows)
        for start in range(0, found.num_rows, request.limit):
            yield found.select(list(request.columns)).slice(start, request.limit)

    def opened(self):
        from pathlib import Path

        found = [json.loads(p.read_text()) for p in Path(self.folder).glob("open-*.json")]
        return sorted(found, key=lambda r: -1 if r["start"] is None else r["start"])


@pytest.fixture
def store(tmp_path):
    return Recorder(tmp_path)


def test_a_scan_opens_each_range_once(spark, store):
    rows = ranged_source(spark, store, PLAN, "k", SCHEMA, batch_size=3)
    assert sorted(r["k"] for r in rows.collect()) == KEYS
    assert [(r["start"], r["end"], r["rows"]) for r in store.opened()] == [(None, 10, 11), (10, 20, 10), (20, 30, 10), (30, None, 9)]


@pytest.mark.parametrize(
    "condition,ranges",
    [
        ("k > 12 AND k <= 25", [(12, 20), (20, 25)]),
        ("k >= 12 AND k < 25", [(12, 20), (20, 25)]),
        ("k = 20", [(20, 20)]),
        ("k IN (3, 31, 35, 99)", [(3, 3), (31, 99)]),
        ("k BETWEEN 10 AND 11", [(10, 10), (10, 11)]),
        ("k > 10 AND k IN (10, 11, 12) AND k <> 12", [(11, 12)]),
        ("k > 50", [(50, None)]),
        ("k < 0", [(None, 0)]),
        ("k IN (5) AND k IN (6)", []),
        ("k IS NULL", [(None, 10), (10, 20), (20, 30), (30, None)]),
        ("k + 1 = 5", [(None, 10), (10, 20), (20, 30), (30, None)]),
    ],
)
def test_filters_on_the_key_narrow_the_ranges(spark, store, condition, ranges):
    rows = ranged_source(spark, store, PLAN, "k", SCHEMA, batch_size=4).where(condition)
    expected = spark.createDataFrame([(k,) for k in KEYS], "k bigint").where(condition).collect()
    assert sorted(r["k"] for r in rows.collect()) == [r["k"] for r in expected]
    assert [(r["start"], r["end"]) for r in store.opened()] == ranges


def test_other_filters_and_the_chosen_columns_reach_the_source(spark, store):
    rows = ranged_source(spark, store, PLAN, "k", SCHEMA, columns=["w", "v"]).where("v = 'v1' AND w > 4").select("w")
    assert sorted(r["w"] for r in rows.collect()) == [k / 2 for k in KEYS if k % 3 == 1 and k / 2 > 4]
    calls = store.opened()
    assert all(c["columns"] == ["w", "v"] and c["filters"] >= 2 for c in calls)
    assert sum(c["rows"] for c in calls) == len([k for k in KEYS if k % 3 == 1 and k / 2 > 4])


def test_a_source_that_ignores_filters_gives_the_same_rows(spark):
    def pages(request):
        rows = pa.table({"k": pa.array([k for k in KEYS if (request.start is None or k > request.start or (request.from_start and k == request.start)) and (request.end is None or k <= request.end)], pa.int64())})
        yield rows.append_column("v", pa.array([f"v{k % 3}" for k in rows["k"].to_pylist()])).append_column("w", pa.array([0.0] * rows.num_rows))

    rows = ranged_source(spark, pages, PLAN, "k", SCHEMA).where("v = 'v2' AND k >= 17")
    assert sorted(r["k"] for r in rows.collect()) == [k for k in KEYS if k % 3 == 2 and k >= 17]


@pytest.mark.parametrize("condition", ["k >= 'k12' AND k < 'k31'", "k IN ('k05', 'k10', 'k11', 'k33')", "k = 'k20'", "k > 'k20'"])
def test_a_page_by_page_source_of_text_keys(spark, tmp_path, condition):
    """Such a source can only start after a key, and a key before a given text is not known."""
    keys = [f"k{k:02}" for k in KEYS]
    plan = [Row(range_id=i, start_key=s, end_key=e) for i, (s, e) in enumerate([(None, "k10"), ("k10", "k20"), ("k20", None)])]
    recorder = Recorder(tmp_path)

    def fetch(start, end, limit):
        wanted = [k for k in keys if (start is None or k > start) and (end is None or k <= end)][:limit]
        recorder.note("page", start=start, rows=len(wanted))
        return pa.table({"k": pa.array(wanted, pa.string())})

    rows = paged_source(spark, fetch, plan, "k", "k string", 4).where(condition)
    expected = spark.createDataFrame([(k,) for k in keys], "k string").where(condition).collect()
    assert sorted(r["k"] for r in rows.collect()) == [r["k"] for r in expected]


def test_columns_must_be_known(spark):
    with pytest.raises(ValueError, match="outside the schema"):
        ranged_source(spark, lambda _: [], PLAN, "k", SCHEMA, columns=["x"])


def test_bounds_of_filters():
    part = KeyRange(1, 10, 20)
    k = ("k",)
    assert KeyBounds.of([GreaterThan(("other",), 15)], "k").narrow(part) == part
    assert KeyBounds.of([GreaterThan(k, float("nan"))], "k").narrow(part) == part
    assert KeyBounds.of([GreaterThan(k, datetime(2024, 1, 1))], "k").narrow(part) == part
    assert KeyBounds.of([GreaterThan(k, 20)], "k").narrow(part) is None
    assert KeyBounds.of([LessThanOrEqual(k, 10)], "k").narrow(part) is None
    assert KeyBounds.of([GreaterThan(k, 12), GreaterThan(k, 14), LessThanOrEqual(k, 17)], "k").narrow(part) == KeyRange(1, 14, 17, after=14)
    days = KeyRange(0, date(2024, 1, 1), date(2024, 2, 1))
    assert KeyBounds.of([GreaterThan(k, date(2024, 1, 9))], "k").narrow(days).start == date(2024, 1, 9)


def test_conditions_as_sql():
    filters = (
        EqualTo(("s",), "it's"), In(("n",), (1, Decimal("2.5"), None)), Not(EqualTo(("b",), True)), IsNotNull(("d",)), IsNull(("e",)),
        GreaterThan(("t",), datetime(2024, 1, 1)), StringContains(("s",), "x"), GreaterThan(("d",), date(2024, 1, 2)), EqualTo(("f",), float("nan")),
    )
    request = PageRequest("a", "b\"'", 5, True, (), filters)
    text = sql_condition(request, 'k"ey')
    assert text == (
        "\"k\"\"ey\" >= 'a' AND \"k\"\"ey\" <= 'b\"''' AND \"s\" = 'it''s' AND \"n\" IN (1, 2.5) AND NOT (\"b\" = TRUE) "
        'AND "d" IS NOT NULL AND "e" IS NULL AND "d" > DATE \'2024-01-02\''
    )
    assert sql_condition(PageRequest(None, None, 5), "k") == "1 = 1"


def test_a_database_is_asked_for_bounds_columns_and_conditions(spark, folder):
    """A database of the worker's own process, read over the table's file: only the wanted rows leave it."""

    def pages(request):
        names = ", ".join(f'"{c}"' for c in request.columns)
        text = f"SELECT {names} FROM '{folder}/orders.parquet' WHERE {sql_condition(request, 'o_orderkey')} ORDER BY o_orderkey"
        reader = duckdb.connect().execute(text).to_arrow_reader(request.limit)
        for batch in reader:
            yield pa.Table.from_batches([batch])

    plan = [Row(range_id=i, start_key=s, end_key=e) for i, (s, e) in enumerate([(None, 1000), (1000, 3000), (3000, None)])]
    rows = ranged_source(spark, pages, plan, "o_orderkey", "o_orderkey bigint, o_totalprice double, o_orderstatus string", 100)
    condition = "o_orderkey >= 900 AND o_orderkey < 5000 AND o_orderstatus IN ('F', 'P')"
    orders = spark.read.parquet(f"{folder}/orders.parquet").where(condition)
    got = rows.where(condition).agg(F.count("*"), F.sum("o_orderkey")).first()
    assert tuple(got) == tuple(orders.agg(F.count("*"), F.sum("o_orderkey")).first())
