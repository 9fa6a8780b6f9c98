import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import payload
from vecflow.queries import function_queries


def narrowed(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    value = payload.narrow_number(F.col("t"))
    out = rows.orderBy("i").select(F.schema_of_variant(value), F.to_json(value)).collect()
    return [(r[0].split("(")[0], r[1]) for r in out]


def test_narrowing_prefers_integers_then_doubles(spark):
    texts = ["1", "-7", "+5", "1.0", "1e3", " 1 ", "1d", "x", "", "9223372036854775807",
             "-9223372036854775808", "9223372036854775808", "0" * 40 + "5", "1e400", "1" * 60]
    assert narrowed(spark, texts) == [
        ("BIGINT", "1"), ("BIGINT", "-7"), ("BIGINT", "5"), ("DOUBLE", "1.0"),
        ("DOUBLE", "1000.0"), ("STRING", '" 1 "'), ("STRING", '"1d"'), ("STRING", '"x"'),
        ("STRING", '""'), ("BIGINT", "9223372036854775807"), ("BIGINT", "-9223372036854775808"),
        ("DOUBLE", "9.223372036854776E18"), ("BIGINT", "5"), ("STRING", '"1e400"'),
        ("DOUBLE", "1.1111111111111112E59"),
    ]


def test_numeric_attributes_fall_back_to_text(spark):
    cases = [("NUMERIC", "1.5", 1.5), ("NUMERIC", "1d", "1d"), ("NUMERIC", " 1", " 1"),
             ("NUMERIC", ".5", 0.5), ("NUMERIC", "5.", 5.0), ("NUMERIC", "1e400", "1e400"),
             ("TEXT", "1.5", "1.5"), ("", "x", "x")]
    rows = spark.createDataFrame([(k, t) for k, t, _ in cases], "k string, t string")
    got = rows.select(payload.parse_field(F.col("k"), F.col("t"))).collect()
    assert [r[0].toPython() for r in got] == [e for _, _, e in cases]


@pytest.mark.parametrize(
    "text,value",
    [("1_23.50_0e+1_2", 123.5e12), ("0x1p-2", 0.25), ("-0X_1.8p3", -12.0), ("1_", None), ("_1", None),
     ("1__0", None), ("1_.5", None), ("1e_5", None), ("0x1", None), ("0b1", None), ("1f", None), ("+.e1", None),
     ("1.e2", 100.0), ("+7", 7.0), ("\u0661", None), ("1\n", None)],
)
def test_number_spellings(spark, text, value):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(payload.as_number(F.col("t"))).first()[0] == value


def test_special_numbers(spark):
    rows = spark.createDataFrame([("NaN",), ("-inf",), ("+Infinity",), ("-nan",)], "t string")
    got = [r[0] for r in rows.select(payload.as_number(F.col("t"))).collect()]
    assert str(got) == "[nan, -inf, inf, None]"


def test_sanitizing_nested_values(spark):
    schema = T.StructType([T.StructField("r", T.StructType([
        T.StructField("small", T.ShortType()), T.StructField("amount", T.DecimalType(20, 3)),
        T.StructField("at", T.TimestampType()),
        T.StructField("by_day", T.MapType(T.StringType(), T.ArrayType(T.TimestampType()))),
        T.StructField("key", T.BinaryType()), T.StructField("none", T.StructType([
            T.StructField("x", T.IntegerType())])),
    ]))])
    at = datetime(2024, 1, 1, 0, 9, 58, 123456, tzinfo=timezone.utc)
    rows = spark.createDataFrame(
        [((7, Decimal("12345678901234567.125"), at, {"d": [at, None]}, bytearray(16), None),)], schema
    )
    clean = payload.sanitize(F.col("r"), schema["r"].dataType)
    assert json.loads(rows.select(F.to_json(F.to_variant_object(clean))).first()[0]) == {
        "small": 7, "amount": "12345678901234567.125", "at": "2024-01-01T00:09:58Z",
        "by_day": {"d": ["2024-01-01T00:09:58Z", None]},
        "key": "00000000-0000-0000-0000-000000000000", "none": None,
    }


def test_id_field_clash_both_ways(spark):
    fields = payload.object_fields(F.parse_json(F.lit('{"__id__":"own","a":null}')))
    row = spark.range(1).select(*[
        F.to_json(payload.pack_fields(payload.with_id_field(fields, "__id__", F.lit("source"), wins)))
        for wins in (True, False)
    ]).first()
    assert [json.loads(t) for t in row] == [{"__id__": "own", "a": None}, {"__id__": "source", "a": None}]


@pytest.mark.parametrize("text,expected", [("words", "words"), ("", "kept"), (None, "kept")])
def test_document_is_written_only_with_text(spark, text, expected):
    fields = payload.object_fields(F.parse_json(F.lit('{"document":"kept"}')))
    written = payload.with_document(fields, "document", F.lit(text).cast("string"))
    assert json.loads(spark.range(1).select(F.to_json(payload.pack_fields(written))).first()[0]) == {
        "document": expected
    }


@pytest.mark.parametrize("text", ["[1]", "1", '"{"', "{"])
def test_json_payload_must_be_an_object(spark, text):
    rows = spark.createDataFrame([(text,)], "t string")
    assert rows.select(payload.parse_json_object(F.col("t"), strict=False)).first()[0] is None
    with pytest.raises(Exception):
        rows.select(payload.parse_json_object(F.col("t"))).collect()


def test_json_object_may_open_with_blanks(spark):
    rows = spark.createDataFrame([("\n\t {\"a\": 1}",)], "t string")
    assert rows.select(F.to_json(payload.parse_json_object(F.col("t")))).first()[0] == '{"a":1}'


def test_sanitized_ids_may_exceed_a_small_integer(spark, tmp_path):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(1, at, 32_768, "view", 1.5), (2, at, 2**31 - 1, "view", None), (3, at, None, None, 2.0)]
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    found = function_queries.sanitize_payload(spark, str(tmp_path)).orderBy("event_id").collect()
    assert [r["user_small"] for r in found] == [32_768, 2**31 - 1, None]
