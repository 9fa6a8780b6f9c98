"""Search indexes and document stores: schemaless records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids, payload, vectors
from vecflow.schema import DENSE, ID_FIELD, to_points
from vecflow.sources.records import (
    VectorRule,
    as_variant,
    copies_with_ids,
    required,
    split_record,
)

# Fixed value: how a native object id is spelled as text unless the caller says otherwise.
OBJECT_ID_FORMAT = 'ObjectID("%s")'


def read_json_records(spark: SparkSession, path: str, column: str = "record") -> DataFrame:
    """JSON lines as one variant per record, with no schema inference pass."""
    return spark.read.option("singleVariantColumn", column).json(path)


def from_es_hits(
    hits: DataFrame, id_field: str = ID_FIELD, vector_fields: Sequence[str] | None = None
) -> DataFrame:
    """Hits ``(_id, _source[, fields])``: number lists are vectors, an empty list is not.

    Vectors found only under ``fields`` are added, same-named ones replaced.
    """
    rule = VectorRule(empty_is_vector=False, only=_names(vector_fields))
    split = split_record(_checked_hits(hits), "_source", rule)
    if "fields" in hits.columns:
        split = split_record(split, "fields", rule, dense="_extra", fields="_ignored")
        extra = F.coalesce(F.col("_extra"), F.create_map().cast(DENSE))
        split = split.withColumn("_dense", vectors.overlay_vectors(F.col("_dense"), extra))
    return _document_points(split, F.col("_id"), id_field)


def from_os_hits(
    hits: DataFrame, id_field: str = ID_FIELD, vector_fields: Sequence[str] | None = None
) -> DataFrame:
    """Hits ``(_id, _source)``; an empty list counts as an (empty) vector here."""
    rule = VectorRule(empty_is_vector=True, only=_names(vector_fields))
    return _document_points(
        split_record(_checked_hits(hits), "_source", rule), F.col("_id"), id_field
    )


def from_solr_docs(
    docs: DataFrame,
    id_field: str = ID_FIELD,
    record: str = "doc",
    vector_fields: Sequence[str] | None = None,
    missing_ids: str = "derive",
) -> DataFrame:
    """Flat documents whose ``id`` stays in the payload and is copied to the id field.

    A document without an id gets one derived from its content, so that two such
    documents never share a point. That takes a second pass over ``docs``; where
    every document is known to have an id, ``missing_ids="fail"`` spares it.
    """
    rule = VectorRule(empty_is_vector=True, only=_names(vector_fields))
    whole = _whole_records(docs, record)
    schema = whole.schema["_doc"].dataType
    if not isinstance(schema, T.StructType):
        known_id, parsed = F.variant_get("_doc", "$.id", "string"), F.parse_json("record")
        text = F.to_json("_doc")
    else:
        known_id, parsed = _struct_field(schema, "id").cast("string"), F.from_json("record", schema)
        # By way of a variant, whose text does not depend on the order of fields.
        text = F.to_json(F.parse_json(F.to_json("_doc")))
    if missing_ids == "fail":
        checked = required(known_id, "id is missing", T.StringType())
        identified = whole.select("_doc", checked.alias("_original_id"))
    elif missing_ids == "derive":
        named = whole.where(known_id.isNotNull()).select("_doc", known_id.alias("_original_id"))
        anonymous = copies_with_ids(
            whole.where(known_id.isNull()).select(text.alias("record"))
        ).select(parsed.alias("_doc"), F.col("record_id").alias("_original_id"))
        identified = named.unionByName(anonymous)
    else:
        raise ValueError(f"missing_ids must be 'derive' or 'fail', not {missing_ids!r}")
    split = split_record(identified, "_doc", rule)
    return _document_points(split, F.col("_original_id"), id_field)


def from_mongo_docs(
    docs: DataFrame,
    vector_fields: Sequence[str],
    id_field: str = ID_FIELD,
    record: str = "doc",
    object_id_format: str = OBJECT_ID_FORMAT,
) -> DataFrame:
    """Extended-JSON documents; only listed fields holding float lists become vectors.

    Point ids of native object ids are derived from their text, so a copy has to
    keep the ``object_id_format`` of the copies before it.
    """
    rule = VectorRule(empty_is_vector=True, floats_only=True, only=tuple(vector_fields))
    whole = _whole_records(docs, record)
    schema = whole.schema["_doc"].dataType
    if not isinstance(schema, T.StructType):
        raw_id = F.variant_get("_doc", "$._id", "variant")
        object_id = F.try_variant_get("_doc", "$._id['$oid']", "string")
        text = F.when(F.schema_of_variant(raw_id) == "STRING", raw_id.cast("string"))
    else:
        text, object_id = _struct_object_id(schema)
    native = F.when(object_id.isNotNull(), F.format_string(object_id_format, object_id))
    original_id = required(
        F.coalesce(text, native), "_id is neither an object id nor text", T.StringType()
    )
    named = whole.withColumn("_original_id", original_id)
    split = split_record(named, "_doc", rule).withColumn(
        "_fields", payload.drop_fields(F.col("_fields"), "_id")
    )
    return _document_points(split, F.col("_original_id"), id_field)


def _names(fields: Sequence[str] | None) -> tuple[str, ...] | None:
    return None if fields is None else tuple(fields)


def _whole_records(docs: DataFrame, record: str) -> DataFrame:
    """Records under one name: structs stay typed, everything else becomes a variant."""
    typed = isinstance(docs.schema[record].dataType, T.StructType)
    return docs.select((F.col(record) if typed else as_variant(docs, record)).alias("_doc"))


def _struct_field(schema: T.StructType, name: str) -> Column:
    return F.col("_doc")[name] if name in schema.fieldNames() else F.lit(None)


def _struct_object_id(schema: T.StructType) -> tuple[Column, Column]:
    """The ``_id`` of a typed document as text and as object id, one of them null."""
    nothing = F.lit(None).cast("string")
    kind = schema["_id"].dataType if "_id" in schema.fieldNames() else None
    if isinstance(kind, T.StringType):
        return F.col("_doc")["_id"], nothing
    if isinstance(kind, T.StructType) and "$oid" in kind.fieldNames():
        return nothing, F.col("_doc")["_id"]["$oid"]
    return nothing, nothing


def _checked_hits(hits: DataFrame) -> DataFrame:
    """Hits whose parts are there; a _source that is no object stops where it is split."""
    types = {f.name: f.dataType for f in hits.schema}
    if not isinstance(types["_id"], T.StringType):
        raise ValueError("_id must be text")
    return hits.withColumns(
        {c: required(F.col(c), f"{c} is missing", types[c]) for c in ("_id", "_source")}
    )


def _document_points(split: DataFrame, original_id, id_field: str) -> DataFrame:
    fields = payload.with_id_field(F.col("_fields"), id_field, original_id, document_wins=True)
    return to_points(
        split,
        id=ids.text_id(original_id),
        dense=F.col("_dense"),
        payload=payload.pack_fields(fields),
    )
