import uuid
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids

PLAIN = "6F1E9D2A-1234-4abc-8def-0123456789AB"
KEPT = [
    PLAIN,
    PLAIN.lower(),
    f"urn:uuid:{PLAIN}",
    f"URN:UUID:{PLAIN}",
    "{" + PLAIN + "}",
    "(" + PLAIN + ")",
    PLAIN.replace("-", ""),
]
HASHED = [
    "",
    "1",
    "doc-1",
    PLAIN + "0",
    PLAIN[:-1] + "g",
    PLAIN.replace("-", "_"),
    PLAIN.replace("-", "")[:-1],
    PLAIN + "\n",
    "uuid:urn:" + PLAIN,
    "é" + PLAIN + "é",
    "こんにちは",
]


def uuids(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in rows.select(ids.arbitrary_id_to_uuid(F.col("t"))).collect()]


def test_uuid_spellings_are_kept_verbatim(spark):
    assert uuids(spark, KEPT) == KEPT


def test_other_text_is_hashed_in_the_url_namespace(spark):
    assert uuids(spark, HASHED) == [str(uuid.uuid5(uuid.NAMESPACE_URL, t)) for t in HASHED]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"])), min_size=1, max_size=50))
def test_hashing_equals_the_standard_library(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(ids.uuid5(F.col("t"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, t)) for t in texts]


def test_missing_text_has_no_id(spark):
    assert uuids(spark, [None]) == [None]


def test_binary_keys(spark):
    sixteen, seventeen = bytes(range(16)), b"seventeen bytes!!"
    rows = spark.createDataFrame([(bytearray(b),) for b in (sixteen, seventeen, b"")], "k binary")
    got = [r[0] for r in rows.select(ids.key_to_string(F.col("k"), T.BinaryType())).collect()]
    assert got == [str(uuid.UUID(bytes=sixteen)), seventeen.decode(), ""]


def test_numeric_ids_cover_the_unsigned_range(spark):
    rows = spark.sql("SELECT 18446744073709551615BD AS n")
    assert str(rows.select(ids.numeric_id(F.col("n"))["num"]).first()[0]) == "18446744073709551615"


@pytest.mark.parametrize("number", ["-1", "18446744073709551616BD"])
def test_numbers_outside_it_stop_the_job(spark, number):
    with pytest.raises(SparkRuntimeException, match="not an unsigned"):
        spark.sql(f"SELECT {number} AS n").select(ids.numeric_id(F.col("n"))).collect()


def test_ids_order_missing_then_numbers_then_uuids(spark):
    numbers = [Decimal(9), Decimal(10), Decimal(2**64 - 1)]
    values = [None, *[(n, None) for n in numbers], (None, "B"), (None, "b")]
    rows = spark.createDataFrame(
        [(v,) for v in reversed(values)], "id struct<num decimal(20,0), uuid string>"
    )
    ordered = [r[0] for r in rows.orderBy(*ids.id_sort_columns()).collect()]
    assert [v and tuple(v) for v in ordered] == values
    by_key = rows.where("id is not null").orderBy(ids.id_sort_key(F.col("id"))).collect()
    assert [tuple(r[0]) for r in by_key] == values[1:]
