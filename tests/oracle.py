"""Run queries next to their SQL on the same tables and compare the rows.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def compare(spark_df, connection, sql: str) -> str | None:
    """What differs, or None."""
    relation = connection.sql(sql)
    names, sql_names = sorted(spark_df.columns), sorted(relation.columns)
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    ours = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    expected = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN"}
    wrong = [(c, ours[c], types[c]) for c in names if expected.get(ours[c]) != types[c]]
    if wrong:
        return f"types {wrong}"
    left = Counter(
        tuple(_plain(row[n]) for n in names) for row in spark_df.toLocalIterator()
    )
    position = [relation.columns.index(n) for n in names]
    right = Counter(tuple(_plain(row[i]) for i in position) for row in relation.fetchall())
    if left == right:
        return None
    only_left, only_right = list((left - right).items())[:3], list((right - left).items())[:3]
    return (
        f"{sum(left.values())} rows against {sum(right.values())}\n"
        f"    spark only {names}: {only_left}\n    sql only: {only_right}"
    )


def main() -> int:
    from conftest import make_session

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:]
    spark, connection, bad = make_session(), connect(folder), 0
    sqls = oracle_sql()
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            frame = run(spark, folder)
            if name in sqls:
                problem = compare(frame, connection, sqls[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - started:.2f}s "
              f"{'' if name in sqls else '(rows only) '}{problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
