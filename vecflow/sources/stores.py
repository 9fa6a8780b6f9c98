"""Key-value and vector stores: records of a known outer shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions import ids, payload, vectors
from vecflow.schema import DOCUMENT_FIELD, FIELDS, ID_FIELD, SPARSE, to_points
from vecflow.sources.records import Rule, as_variant, check_records, required


def from_redis_hashes(
    hashes: DataFrame, attribute_types: dict[str, str], id_field: str = ID_FIELD
) -> DataFrame:
    """Rows ``(key, fields map<string,binary>)`` typed by the index's attributes.

    VECTOR fields are float32 bytes, NUMERIC ones numbers, the rest text. Each
    vector attribute is one column, so bytes cross to Python only for those.
    """
    vector_names = [n for n, kind in attribute_types.items() if kind == "VECTOR"]
    decoded = {n: vectors.bytes_to_floats(F.col("fields")[n]) for n in vector_names}
    wide = hashes.select(
        "key", "fields", *[c.alias(f"_vector_{i}") for i, c in enumerate(decoded.values())]
    )
    dense = {n: F.col(f"_vector_{i}") for i, n in enumerate(decoded)}
    kinds = F.create_map(
        *[F.lit(x) for name in attribute_types.items() for x in name]
    ) if attribute_types else F.create_map().cast("map<string,string>")
    scalars = F.transform_values(
        payload.drop_fields(F.col("fields"), *vector_names) if vector_names else F.col("fields"),
        lambda k, v: payload.parse_field(F.coalesce(kinds[k], F.lit("")), F.decode(v, "UTF-8")),
    )
    return to_points(
        wide,
        id=_present_id("key"),
        dense=vectors.named_vectors(dense),
        payload=payload.pack_fields(
            payload.with_id_field(scalars, id_field, F.col("key"), document_wins=False)
        ),
    )


def from_weaviate_objects(objects: DataFrame) -> DataFrame:
    """Objects with ``_additional{id, vector}``; the id is a UUID and kept as is."""
    extra = F.col("_additional")
    checked = check_records(
        objects,
        [
            Rule("_additional is missing", extra.isNull()),
            Rule("id is missing", extra["id"].isNull()),
            Rule("id is not a UUID", ~ids.is_uuid(extra["id"])),
            Rule("vector is missing", extra["vector"].isNull()),
            Rule("vector holds a non-number", F.exists(extra["vector"], lambda x: x.isNull())),
        ],
    )
    properties = {
        f.name: payload.sanitize(F.col(f.name), f.dataType)
        for f in objects.schema
        if f.name != "_additional"
    }
    return to_points(
        checked,
        id=ids.uuid_id(extra["id"]),
        dense=vectors.unnamed_vector(extra["vector"].cast("array<float>")),
        payload=payload.pack_columns(properties),
    )


def from_pinecone(
    records: DataFrame, sparse_name: str = "sparse", id_field: str = ID_FIELD
) -> DataFrame:
    """Rows ``(id[, values][, sparse_values][, metadata])``, either vector optional."""
    columns = records.columns
    parts: dict[str, Column] = {}
    if "values" in columns:
        parts["dense"] = vectors.unnamed_vector(F.col("values").cast("array<float>"))
    if "sparse_values" in columns:
        sparse = F.col("sparse_values")
        parts["sparse"] = vectors.named_vectors(
            {
                sparse_name: F.when(
                    sparse.isNotNull(), vectors.make_sparse(sparse["indices"], sparse["values"])
                )
            },
            SPARSE,
        )
    return to_points(
        records,
        id=_present_id("id"),
        payload=_metadata_payload(records, "metadata", F.col("id"), id_field),
        **parts,
    )


def from_s3_vectors(
    records: DataFrame, id_field: str = ID_FIELD, number_fields: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(key, data[, metadata])``; metadata numbers narrow to integers where they fit.

    JSON metadata carries its number types itself. Where metadata is a struct or
    map holding numbers as text, ``number_fields`` names them.
    """
    checked = check_records(
        records,
        [
            Rule("key is missing", F.col("key").isNull()),
            Rule("data is not a float vector", F.col("data").isNull()),
        ],
    )
    return to_points(
        checked,
        id=ids.text_id(F.col("key")),
        dense=vectors.unnamed_vector(F.col("data").cast("array<float>")),
        payload=_metadata_payload(records, "metadata", F.col("key"), id_field, number_fields),
    )


def from_chroma_get(
    pages: DataFrame, id_field: str = ID_FIELD, document_field: str = DOCUMENT_FIELD
) -> DataFrame:
    """Pages of parallel arrays ``(ids, embeddings, documents, metadatas)``, one row per record.

    A page may lack any array but the ids; its records then lack that part, as do those past the end of a shorter
    array of documents or metadata. Embeddings come for all ids of a page or for none: fewer stop the job.
    """
    names = ("ids", "embeddings", "documents", "metadatas")
    held = F.size(F.coalesce(F.col("embeddings"), F.array().cast(pages.schema["embeddings"].dataType)))
    pages = check_records(pages, [Rule("embeddings are fewer than ids", (held > 0) & (held < F.size("ids")))])
    present = [F.coalesce(c, F.array().cast(pages.schema[c].dataType)).alias(c) for c in names]
    rows = pages.select(*present).select(F.inline(F.arrays_zip(*names)))
    fields = _metadata_fields(rows, "metadatas")
    fields = payload.with_id_field(fields, id_field, F.col("ids"), document_wins=False)
    fields = payload.with_document(fields, document_field, F.col("documents"))
    return to_points(
        rows,
        id=_present_id("ids"),
        dense=vectors.unnamed_vector(F.col("embeddings").cast("array<float>")),
        payload=payload.pack_fields(fields),
    )


def from_milvus_columns(
    pages: DataFrame, primary_key: str, vector_dims: dict[str, Column | int]
) -> DataFrame:
    """Columnar pages: one array per field, vectors as one flat buffer of known dimension.

    An int64 primary key stays a number, a text one becomes a UUID; neither is
    kept in the payload. Field types outside the supported set stop the job
    before it starts.
    """
    elements = {f.name: f.dataType.elementType for f in pages.schema if _is_array(f.dataType)}
    scalars = [n for n in elements if n not in vector_dims and n != primary_key]
    for name in scalars:
        if not isinstance(elements[name], _SCALAR_FIELDS):
            raise ValueError(f"unsupported type of field {name}: {elements[name].simpleString()}")
    key_type = elements[primary_key]
    flat = pages.withColumn("_pos", F.explode(F.sequence(F.lit(0), F.size(primary_key) - 1))).where(
        F.size(primary_key) > 0
    )
    at = {n: F.get(F.col(n), F.col("_pos")) for n in [primary_key, *scalars]}
    dense = {}
    for name, dim in vector_dims.items():
        size = dim if isinstance(dim, Column) else F.lit(dim)
        whole = F.size(F.col(name)) == F.size(primary_key) * size
        stop = F.raise_error(F.lit(f"vectors of field {name} do not fill the page"))
        part = vectors.flat_slice(F.col(name), F.col("_pos"), size)
        dense[name] = F.when(F.col(name).isNull() | whole, part).otherwise(stop.cast(pages.schema[name].dataType))
    key = at[primary_key]
    if isinstance(key_type, T.StringType):
        point_id = ids.text_id(key)
    elif isinstance(key_type, T.LongType):
        point_id = ids.numeric_id(key)
    else:
        raise ValueError("the primary key must be int64 or text")
    return to_points(
        flat,
        id=point_id,
        dense=vectors.named_vectors(dense),
        payload=payload.pack_columns({n: _widened(at[n], elements[n]) for n in scalars}),
    )


_SCALAR_FIELDS = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
    T.VariantType,
)


def _present_id(name: str) -> Column:
    return ids.text_id(required(F.col(name), "id is missing", T.StringType()))


def _is_array(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType)


def _widened(value: Column, data_type: T.DataType) -> Column:
    return value.cast("bigint") if isinstance(data_type, T.IntegralType) else value


def _metadata_fields(df: DataFrame, name: str, number_fields: Sequence[str] = ()) -> Column:
    """Metadata of any outer type as a field map; absent metadata is an empty one."""
    if name not in df.columns:
        return payload.empty_fields()
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.StructType):
        entries = []
        for field in data_type:
            value = F.col(name)[field.name]
            if field.name in number_fields:
                as_field = payload.narrow_numbers(value, field.dataType)
            else:
                as_field = payload.to_variant(
                    payload.sanitize(value, field.dataType), field.dataType
                )
            entries.append(F.struct(F.lit(field.name).alias("key"), as_field.alias("value")))
        present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
        fields = F.map_from_entries(present).cast(FIELDS)
    elif isinstance(data_type, T.MapType):
        value_type = data_type.valueType
        plain = payload.to_variant
        fields = F.transform_values(
            F.col(name),
            lambda k, v: F.when(
                k.isin(*number_fields), payload.narrow_numbers(v, value_type)
            ).otherwise(plain(payload.sanitize(v, value_type), value_type)),
        )
    else:
        fields = payload.object_fields(as_variant(df, name))
    return F.coalesce(fields, payload.empty_fields())


def _metadata_payload(
    df: DataFrame, name: str, original_id: Column, id_field: str, number_fields: Sequence[str] = ()
) -> Column:
    fields = _metadata_fields(df, name, number_fields)
    return payload.pack_fields(
        payload.with_id_field(fields, id_field, original_id, document_wins=False)
    )
