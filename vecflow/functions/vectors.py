"""Dense, sparse and multi vectors as columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.schema import DENSE, UNNAMED

_NUMERIC_LIST = r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))>$"
_NUMERIC_OR_EMPTY_LIST = r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|VOID)>$"


def numeric_array(value: Column, empty_is_vector: bool, floats_only: bool = False) -> Column:
    """The variant as ``array<float>`` when it is a list of numbers, else null.

    One type test covers the whole list: any text, boolean or nested element
    turns its common type into VARIANT, and only nulls need a second look (a list
    of nothing else has the type of an empty one). ``floats_only`` rejects lists
    holding an integer. Numbers go through double precision, as decoded JSON does.
    """
    kinds = _NUMERIC_OR_EMPTY_LIST if empty_is_vector else _NUMERIC_LIST
    accepted = F.schema_of_variant(value).rlike(kinds)
    if floats_only:
        elements = F.try_variant_get(value, "$", "array<variant>")
        accepted = accepted & ~F.exists(elements, lambda x: F.schema_of_variant(x) == "BIGINT")
    # The list is read once: a lambda names it for its two uses.
    numbers = F.array(F.try_variant_get(value, "$", "array<double>"))
    without_nulls = F.transform(
        numbers, lambda n: F.when(~F.exists(n, lambda x: x.isNull()), n.cast("array<float>"))
    )
    return F.when(accepted, F.get(without_nulls, F.lit(0)))


def is_numeric_array(value: Column, empty_is_vector: bool, floats_only: bool = False) -> Column:
    return numeric_array(value, empty_is_vector, floats_only).isNotNull()


def typed_numeric_array(
    column: Column, data_type: T.DataType, empty_is_vector: bool, floats_only: bool = False
) -> Column | None:
    """The same decision for a column of known type; None when it can never be a vector."""
    if not isinstance(data_type, T.ArrayType):
        return None
    element = data_type.elementType
    fractional = isinstance(element, (T.FractionalType, T.NullType))
    if not fractional and (floats_only or not isinstance(element, T.IntegralType)):
        return None
    accepted = ~F.exists(column, lambda x: x.isNull())
    if not empty_is_vector:
        accepted = accepted & (F.size(column) > 0)
    return F.when(accepted, column.cast("array<float>"))


def named_vectors(vectors: dict[str, Column], data_type: str = DENSE) -> Column:
    """Map of the vectors that are present; an absent vector has no entry."""
    empty = F.create_map().cast(data_type)
    single = [
        F.when(v.isNotNull(), F.create_map(F.lit(name), v).cast(data_type)).otherwise(empty)
        for name, v in vectors.items()
    ]
    if len(single) < 2:
        return single[0] if single else empty
    return F.map_concat(*single)


def unnamed_vector(vector: Column) -> Column:
    return named_vectors({UNNAMED: vector})


def normalize_vector_set(unnamed: Column, named: Column) -> Column:
    """Either one unnamed vector or a named map, as a map in both cases."""
    single = F.when(F.size(unnamed) > 0, unnamed_vector(unnamed))
    return F.coalesce(single, drop_empty_vectors(named))


def drop_empty_vectors(vectors: Column) -> Column:
    return F.map_filter(vectors, lambda _, v: v.isNotNull() & (F.size(v) > 0))


def convert_vectors(dense: Column, sparse: Column, multi: Column) -> tuple[Column, Column, Column]:
    """Resolve names offered in several forms: sparse beats multi beats dense."""
    sparse_names = F.coalesce(F.map_keys(sparse), F.array().cast("array<string>"))
    multi_kept = F.map_filter(
        multi, lambda k, v: v.isNotNull() & ~F.array_contains(sparse_names, k)
    )
    taken = F.concat(
        sparse_names, F.coalesce(F.map_keys(multi_kept), F.array().cast("array<string>"))
    )
    dense_kept = F.map_filter(
        drop_empty_vectors(dense), lambda k, _: ~F.array_contains(taken, k)
    )
    return dense_kept, sparse, multi_kept


def overlay_vectors(base: Column, override: Column) -> Column:
    """Union of two vector maps where ``override`` wins a shared name."""
    winners = F.map_keys(override)
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(winners, k))
    return F.map_concat(kept, override)


def make_sparse(indices: Column, values: Column) -> Column:
    return F.struct(
        indices.cast("array<bigint>").alias("indices"), values.cast("array<float>").alias("values")
    )


def sparse_as_map(sparse: Column) -> Column:
    """Order-free view of a sparse vector."""
    return F.map_from_arrays(sparse["indices"], sparse["values"])


def flat_slice(buffer: Column, position: Column, dim: Column) -> Column:
    """Vector ``position`` (from 0) out of a buffer holding vectors end to end."""
    return F.slice(buffer, position * dim + 1, dim)


@F.arrow_udf(T.ArrayType(T.FloatType(), containsNull=False))
def bytes_to_floats(raw: pa.Array) -> pa.Array:
    """Little-endian float32 lists; a tail shorter than four bytes is dropped.

    The batch is reinterpreted as a whole: lengths give the list offsets and the
    payload bytes become the float buffer, so no value is touched in Python.
    """
    raw = raw.cast(pa.large_binary())
    lengths = pa.compute.fill_null(pa.compute.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    starts = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw)]
    data = raw.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    counts = lengths // 4
    offsets = np.concatenate([[0], np.cumsum(counts)])
    used = counts * 4
    # Index of every kept byte: its row's start plus its place within the row.
    within = np.arange(offsets[-1] * 4) - np.repeat(offsets[:-1] * 4, used)
    floats = data[np.repeat(starts, used) + within].view("<f4")
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.array(floats, pa.float32()),
        mask=raw.is_null() if raw.null_count else None,
    )


@F.arrow_udf(T.BinaryType())
def floats_to_bytes(vectors: pa.Array) -> pa.Array:
    """Little-endian float32 bytes of each list."""
    flat = np.asarray(vectors.flatten().cast(pa.float32()), dtype="<f4")
    lengths = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0)
    offsets = np.concatenate([[0], np.cumsum(np.asarray(lengths) * 4)]).astype(np.int32)
    valid = None
    if vectors.null_count:
        valid = pa.array(~np.asarray(vectors.is_null())).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(),
        len(vectors),
        [valid, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())],
    )
