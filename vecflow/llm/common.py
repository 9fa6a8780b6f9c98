"""Helpers that several text operators share."""

from __future__ import annotations

import re
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = re.compile("[^\x20\x09-\x0d]+")
SEPARATES = np.isin(np.arange(256), list(b"\x20\x09\x0a\x0b\x0c\x0d"))
#: Texts handed to one Python call hold about this many characters at most (one long text may hold more).
SLICE_CHARS = 4_000_000


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text modulo a divisor; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts are bounded in total."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and total + n > SLICE_CHARS:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a batch, the empty text for null."""
    return [t or "" for t in batch.column(text).to_pylist()]


def values_of(column: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls, cut from its bytes at once."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    cuts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    raw, cuts = data.slice(cuts[0], cuts[-1] - cuts[0]).to_pybytes(), (cuts - cuts[0]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def map_texts(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict], added: list[StructField], keep: list[str]
) -> DataFrame:
    """``keep`` columns of each row plus the columns that ``function`` derives from a batch.

    ``function`` gets a record batch with bounded texts and returns one list or array per added field.
    """
    schema = StructType([df.schema[c] for c in keep] + added)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches):
                made = function(batch)
                arrays = [batch.column(c).cast(arrow.field(c).type) for c in keep]
                arrays += [pa.array(made[f.name], arrow.field(f.name).type) for f in added]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        finally:
            release_caches()

    columns = list(dict.fromkeys([*keep, "text"]))
    return df.select(*columns).mapInArrow(run, schema)


def lookup(rows: DataFrame, values: DataFrame, keys: list[str], times: str, total: int, hot_keys: int) -> DataFrame:
    """``rows`` joined with ``values``, which have one row for each key and in ``times`` how many of ``rows`` hold it.

    Of ``total`` rows at most ``hot_keys`` keys can hold that part each; only these are broadcast. The rest is joined by
    key, and no key of the rest is large.
    """
    is_hot = F.col(times) >= total / hot_keys
    hot, rest = F.broadcast(values.where(is_hot)), values.where(~is_hot)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))


class Bounded(dict):
    """A cache that is emptied when it holds ``limit`` entries; missing values are computed."""

    def __init__(self, function: Callable, limit: int):
        super().__init__()
        self.function, self.limit = function, limit
        _caches.append(weakref.ref(self))

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


_caches: list[weakref.ref[Bounded]] = []
#: Words whose hashes a worker keeps.
CACHED_HASHES = 100_000


def release_caches() -> None:
    """Empty all caches, at the end of a task: a worker is used again by other stages, which have caches of their own."""
    for reference in _caches:
        if (cache := reference()) is not None:
            cache.clear()
    _caches[:] = [r for r in _caches if r() is not None]
    pa.default_memory_pool().release_unused()


word_hash = Bounded(lambda word: xxhash.xxh3_64_intdigest(word), CACHED_HASHES)
