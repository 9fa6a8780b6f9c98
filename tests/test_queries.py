"""Every registered query against its SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry_module
from oracle import compare, connect

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, folder, connection, name):
    frame = QUERIES[name](spark, folder)
    if name in SQL:
        assert compare(frame, connection, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns and frame.count() > 0


def test_id_order_is_kept_in_the_result(spark, folder):
    rows = [tuple(r) for r in QUERIES["point_id_order"](spark, folder).collect()]
    numbers = [int(n) for n, _ in rows if n is not None]
    uuids = [u for _, u in rows if u is not None]
    assert rows == [(str(n), None) for n in sorted(numbers)] + [(None, u) for u in sorted(uuids)]
