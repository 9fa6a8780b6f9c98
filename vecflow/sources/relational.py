"""Tables whose columns are vectors and scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids, payload, vectors
from vecflow.schema import to_points


def is_vector_type(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) and isinstance(
        data_type.elementType, (T.FloatType, T.DoubleType)
    )


def project_columns(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Column subset of the scan; it has to hold the key."""
    if columns is None:
        columns = df.columns
    unknown = [c for c in [key, *columns] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    if key not in columns:
        raise ValueError(f"the column subset must include the key column {key!r}")
    return df.select(*columns)


def from_table(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Table rows to points.

    Every vector-typed column is a vector named after it; every other column,
    the key included, is payload. A missing key stops the job.
    """
    subset = project_columns(df, key, columns)
    schema = {f.name: f.dataType for f in subset.schema}
    key_text = ids.key_to_string(F.col(key), schema[key])
    key_text = F.coalesce(key_text, F.raise_error(F.lit(f"missing key in column {key}")))
    dense = {name: F.col(name) for name, t in schema.items() if is_vector_type(t)}
    scalars = {
        name: payload.sanitize(F.col(name), t) for name, t in schema.items() if name not in dense
    }
    wide = df.select(*subset.columns, *[c for c in carry if c not in subset.columns])
    return to_points(
        wide,
        *carry,
        id=ids.text_id(key_text),
        dense=vectors.named_vectors(dense),
        payload=payload.pack_columns(scalars),
    )


def parse_vector_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Vector columns read over JDBC as text (``[1,2,3]``) back to vectors."""
    parsed = {c: F.from_json(F.col(c), "array<float>", {"mode": "FAILFAST"}) for c in columns}
    return df.withColumns(parsed)


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: dict[str, str]
) -> DataFrame:
    """One JDBC partition per range of a plan (see ``plans.ranges.plan_predicates``)."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
