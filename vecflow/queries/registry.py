"""Registered queries and their SQL equivalents, plus helpers both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.functions.ids import URL_NAMESPACE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its own name, with the SQL that must agree with it."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and every vector, side by side where their ids agree; either may lack the other."""
    vectors = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "_vec_id")
    documents = table(spark, folder, "documents")
    both = vectors.join(documents, vectors["_vec_id"] == documents["doc_id"], "full_outer")
    return both.withColumn("vec_id", F.coalesce("_vec_id", "doc_id")).drop("_vec_id")


VECTOR_ROWS_SQL = """(
      SELECT coalesce(vec_id, doc_id) AS vec_id, embedding, label, doc_id, text, lang, source, n_chars
      FROM embeddings FULL JOIN documents ON vec_id = doc_id)"""


def required_vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector, with its document where there is one: for formats whose records must have a vector."""
    return vector_rows(spark, folder).where(F.col("embedding").isNotNull())


REQUIRED_VECTOR_ROWS_SQL = "embeddings LEFT JOIN documents ON vec_id = doc_id"


def vec_sum(vector: Column) -> Column:
    """Whole-number checksum of a float vector that depends on the order of its values."""
    scaled = F.transform(
        vector, lambda x, i: F.floor(x.cast("double") * 1e6).cast("bigint") * (i + 1)
    )
    return F.aggregate(scaled, F.lit(0).cast("bigint"), lambda a, b: a + b)


def vec_sum_sql(vector: str) -> str:
    return (
        f"CASE WHEN {vector} IS NOT NULL THEN CAST(coalesce(list_sum(list_transform({vector}, "
        "lambda x, i: CAST(floor(CAST(x AS DOUBLE) * 1e6) AS BIGINT) * i)), 0) AS BIGINT) END"
    )


def uuid5_sql(text: str) -> str:
    h = f"sha1(from_hex('{URL_NAMESPACE}') || encode({text}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def names_of(vectors: Column) -> Column:
    return F.array_join(F.sort_array(F.map_keys(vectors)), ",")


def field(name: str, data_type: str) -> Column:
    """A payload field in the given type; null where it is absent."""
    return F.try_variant_get("payload", f"$.{name}", data_type)


def has_field(name: str) -> Column:
    return F.try_variant_get("payload", f"$.{name}", "variant").isNotNull()


def point_uuid() -> Column:
    return F.col("id.uuid").alias("id")
