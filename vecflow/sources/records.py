"""Record-level checks and the split of a record into vectors and payload."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids, payload, vectors
from vecflow.schema import DENSE, FIELDS


@dataclass(frozen=True)
class Rule:
    """A record is bad for ``reason`` where ``broken`` is true."""

    reason: str
    broken: Column


def check_records(df: DataFrame, rules: list[Rule], mode: str = "fail") -> DataFrame:
    """Apply ``rules`` in order.

    ``fail`` stops the job at the first bad record; ``quarantine`` adds a
    ``reason`` column, null for good records.
    """
    reason = F.coalesce(
        *[F.when(F.coalesce(r.broken, F.lit(True)), F.lit(r.reason)) for r in rules],
        F.lit(None).cast("string"),
    )
    if mode == "quarantine":
        return df.withColumn("reason", reason)
    if mode == "fail":
        stop = F.raise_error(F.concat(F.lit("bad record: "), reason)).cast("boolean")
        return df.where(F.when(reason.isNotNull(), stop).otherwise(F.lit(True)))
    raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")


def required(column: Column, reason: str, data_type: T.DataType) -> Column:
    """The column, stopping the job where it is missing.

    Unlike a filter this stays where it is written: a filter on a value parsed
    from text moves below the projection and has the text parsed a second time.
    """
    return F.coalesce(column, F.raise_error(F.lit(f"bad record: {reason}")).cast(data_type))


def split_quarantined(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records without, and bad records with, their ``reason``."""
    return (
        checked.where(F.col("reason").isNull()).drop("reason"),
        checked.where(F.col("reason").isNotNull()),
    )


@dataclass(frozen=True)
class VectorRule:
    """Which fields of a schemaless record become vectors.

    ``only`` limits the choice to listed names; ``empty_is_vector`` and
    ``floats_only`` follow the source at hand.
    """

    empty_is_vector: bool
    floats_only: bool = False
    only: tuple[str, ...] | None = None


def as_variant(df: DataFrame, name: str) -> Column:
    """A column holding records as JSON text, struct, map or variant, as a variant."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.StringType):
        return F.parse_json(F.col(name))
    if isinstance(data_type, T.VariantType):
        return F.col(name)
    return payload.to_variant(payload.sanitize(F.col(name), data_type), data_type)


def split_record(
    df: DataFrame, record: str, rule: VectorRule, dense: str = "_dense", fields: str = "_fields"
) -> DataFrame:
    """Add a vector map and a field map made from the record column.

    Struct records are decided from their schema; for the rest each value is
    looked at. A field that is a vector is not a payload field and vice versa.
    """
    data_type = df.schema[record].dataType
    if isinstance(data_type, T.StructType):
        return _split_struct(df, record, data_type, rule, dense, fields)
    everything = df.withColumn(fields, payload.object_fields(as_variant(df, record)))
    candidates = F.col(fields)
    if rule.only is not None:
        candidates = F.map_filter(candidates, lambda k, _: k.isin(*rule.only))
    found = F.map_filter(
        F.transform_values(
            candidates,
            lambda _, v: vectors.numeric_array(v, rule.empty_is_vector, rule.floats_only),
        ),
        lambda _, v: v.isNotNull(),
    ).cast(DENSE)
    return everything.withColumn(dense, found).withColumn(
        fields, F.map_filter(F.col(fields), lambda k, _: ~F.map_contains_key(F.col(dense), k))
    )


def _split_struct(
    df: DataFrame, record: str, data_type: T.StructType, rule: VectorRule, dense: str, fields: str
) -> DataFrame:
    named: dict[str, Column] = {}
    kept = []
    for field in data_type:
        column = F.col(record)[field.name]
        vector = None
        if rule.only is None or field.name in rule.only:
            vector = vectors.typed_numeric_array(
                column, field.dataType, rule.empty_is_vector, rule.floats_only
            )
        value = payload.to_variant(payload.sanitize(column, field.dataType), field.dataType)
        if vector is not None:
            named[field.name] = vector
            value = F.when(vector.isNull(), value)
        kept.append(F.struct(F.lit(field.name).alias("key"), value.alias("value")))
    present = F.filter(F.array(*kept), lambda e: e["value"].isNotNull())
    return df.withColumn(dense, vectors.named_vectors(named)).withColumn(
        fields, F.map_from_entries(present).cast(FIELDS)
    )


def copies_with_ids(records: DataFrame, text: str = "record") -> DataFrame:
    """Give records that carry no id one each, the same on every run.

    The id is the UUID v5 of the canonical record text and its occurrence
    number. Copies are counted first, so a record repeated in a third of the
    input shuffles as one row per task, and then laid out again in chunks that
    spread over the cluster.
    """
    chunk = 65_536
    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = records.groupBy(text).agg(F.count(F.lit(1)).alias("_n"))
    # A fixed number of tasks: sized by bytes, many chunks would end up in one.
    chunks = counted.withColumn(
        "_first", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(chunk)))
    ).repartition(tasks, text, "_first")
    last = F.least(F.col("_first") + chunk, F.col("_n")) - 1
    return chunks.select(
        text, F.explode(F.sequence(F.col("_first"), last)).alias("occurrence")
    ).withColumn(
        "record_id",
        ids.uuid5(F.concat(F.col(text), F.lit("#"), F.col("occurrence").cast("string"))),
    )
