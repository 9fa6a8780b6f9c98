"""Removal of byte strings that occur more than once, found in suffix order.

A string of ``LENGTH`` bytes is known by the smallest hash among its ``ANCHOR``-byte strings, which depends on nothing
but its content, so equal strings meet under one anchor wherever they are. A stretch is a maximal run of start
positions with one anchor. Stretches whose anchor occurs once hold nothing repeated and are left out by a combining
count: bounded marks of the others' anchors keep nearly all of them from travelling. Equal stretches are one with a
number; all starts of one that occurs twice are repeated. The distinct stretches of an anchor are put into a block whose
suffixes are ordered by linear grouping (``suffix_groups``); starts that are neighbours in that order and agree in
``LENGTH`` bytes are repeated. Stretches first lose what no other stretch of the anchor has: around the anchor, every
string of ``LENGTH`` bytes holds one of some twenty aligned cores.

An anchor with more than ``MANY`` distinct stretches (a passage in very many documents) would be one task's work. Its
strings are dealt by 128-bit hashes of their content instead and counted with map-side combination, which is as exact.

* A null text is an empty text. Texts shorter than ``LENGTH`` bytes keep everything.
* Rows that repeat an id and text are separate documents, so each repeats the other.
* Whole texts are judged on the input, not on what is left; an empty table gives no rows.
* Columns of ``docs`` named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from vecflow.llm.common import map_texts, slices, texts_of
from vecflow.llm.near_copies import among
from vecflow.llm.suffix_groups import suffix_order
from vecflow.scratch import materialize

LENGTH, ANCHOR = 200, 32
#: Distinct stretches of one anchor that a task orders, and the bytes of a block that several anchors share.
MANY, BLOCK_BYTES = 4_000, 200_000
#: Bytes between the aligned cores.
STEP = 8
FACTOR = np.uint64(0x9E3779B97F4A7C15)
OTHER_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)


def window_hashes(data: np.ndarray, size: int, factor: np.uint64 = FACTOR) -> np.ndarray:
    """A hash of every ``size`` consecutive bytes; longer ones are joined from two of half the length."""
    doubled = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    doubled ^= doubled >> np.uint64(29)
    n, have, power = len(data) - size + 1, 1, factor
    total, done = None, 0
    while True:
        if size & have:
            part = doubled[done : done + n]
            total = part.copy() if total is None else total * power + part
            done += have
        if done == size:
            break
        doubled = doubled[:-have] * power + doubled[have:]
        power = power * power + np.uint64(2)
        have *= 2
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values)
    blocks = np.concatenate([values, np.full(-n % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def stretches_of(raw: bytes) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """(anchor, fingerprint, first start, number of starts, first place of the anchor, whether it occurs again)."""
    if len(raw) < LENGTH:
        return
    hashes = window_hashes(np.frombuffer(raw, np.uint8), ANCHOR)
    least = sliding_least(hashes, LENGTH - ANCHOR + 1)
    begins = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    ends = np.r_[begins[1:], len(least)]
    anchors = least[begins]
    # the places of each stretch's anchor: the first from its start on, and whether one more lies inside
    for anchor, begin, end in zip(anchors.view(np.int64).tolist(), begins.tolist(), ends.tolist()):
        inside = hashes[begin : end + LENGTH - ANCHOR]
        at = np.flatnonzero(inside.view(np.int64) == anchor)
        content = xxhash.xxh3_64_intdigest(raw[begin : end - 1 + LENGTH]) - 2**63
        yield anchor, content, begin, end - begin, int(at[0]), len(at) > 1


STRETCHES = StructType(
    [
        StructField("anchor", LongType()),
        StructField("content", LongType()),
        StructField("key", LongType()),
        StructField("start", IntegerType()),
        StructField("starts", IntegerType()),
        StructField("at", IntegerType()),
        StructField("again", BooleanType()),
    ]
)
RANGES = StructType([StructField("key", LongType()), StructField("start", IntegerType()), StructField("end", IntegerType())])
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def stretches(keyed: DataFrame) -> DataFrame:
    def run(batches):
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                rows = []
                for key, text in zip(batch.column("key").to_pylist(), texts_of(batch)):
                    rows += [(a, c, key, *rest) for a, c, *rest in stretches_of(text.encode())]
                yield _batch(rows, _ARROW, STRETCHES.names)

    return keyed.select("key", "text").mapInArrow(run, STRETCHES)


def packed(keyed: DataFrame) -> DataFrame:
    """The same rows with compressed text, which travels cheaply."""
    packer = []

    def pack(batch) -> dict:
        if not packer:
            packer.append(zstandard.ZstdCompressor(level=3))
        return {"packed": [packer[0].compress(t.encode()) for t in texts_of(batch)]}

    return map_texts(keyed, pack, [StructField("packed", BinaryType())], [c for c in keyed.columns if c != "text"])


# ---------------------------------------------------------------- suffix order within anchors


def trimmed(group: list[dict]) -> list[tuple[dict, int, int]]:
    """Stretches with the part of their bytes that some aligned core shares with another stretch."""
    beside = LENGTH - ANCHOR
    cores: Counter = Counter()
    held = []
    for stretch in group:
        raw, at, mine = stretch["bytes"], stretch["at"], []
        if not stretch["again"]:
            for left in range(0, beside + 1, STEP):
                right = max(0, beside - left - (STEP - 1))
                begin, end = at - left, at + ANCHOR + right
                if begin >= 0 and end <= len(raw):
                    mine.append((left, begin, end))
            cores.update((left, raw[b:e]) for left, b, e in mine)
        held.append(mine)
    several = any(s["again"] for s in group)
    parts = []
    for stretch, mine in zip(group, held):
        raw = stretch["bytes"]
        if several:
            parts.append((stretch, 0, len(raw)))
            continue
        shared = [(b, e) for left, b, e in mine if cores[left, raw[b:e]] > 1]
        if shared:
            begin, end = min(b for b, _ in shared) - STEP, max(e for _, e in shared) + STEP
            parts.append((stretch, max(0, begin), min(len(raw), end)))
    return [p for p in parts if p[2] - p[1] >= LENGTH]


def repeated_in_block(parts: list[tuple[dict, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of the repeated bytes in stretches that occur once."""
    text = b"".join(s["bytes"][b:e] for s, b, e in parts)
    valid, base = bytearray(len(text)), 0
    for _, b, e in parts:
        starts = e - b - LENGTH + 1
        valid[base : base + starts] = b"\1" * starts
        base += e - b
    marked = np.zeros(len(text) + 1, np.int8)
    before, string = -1, b""
    for i in suffix_order(text):
        if valid[i]:
            mine = text[i : i + LENGTH]
            if mine == string:
                marked[i] = marked[before] = 1
            before, string = i, mine
    base = 0
    for stretch, b, e in parts:
        if stretch["times"] == 1:
            edges = np.flatnonzero(np.diff(np.r_[0, marked[base : base + e - b], 0].astype(np.int8)))
            first = stretch["start"] + b
            for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
                yield stretch["key"], first + begin, first + end - 1 + LENGTH
        base += e - b


def repeated_by_order(with_bytes: DataFrame) -> DataFrame:
    """Repeated ranges among the distinct stretches of each anchor; anchors of one task share blocks."""
    dealt = with_bytes.repartition("anchor").sortWithinPartitions("anchor", "content")

    def run(batches):
        block, group, rows, size = [], [], [], 0

        def close_group():
            nonlocal size
            if len(group) > 1 or group and group[0]["again"]:
                parts = trimmed(group)
                block.extend(parts)
                size += sum(e - b for _, b, e in parts)
            group.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if group and row["anchor"] != group[0]["anchor"]:
                    close_group()
                    if size >= BLOCK_BYTES:
                        rows += repeated_in_block(block)
                        block, size = [], 0
                group.append(row)
            yield _batch(rows, [pa.int64(), pa.int32(), pa.int32()], RANGES.names)
            rows = []
        close_group()
        if block:
            yield _batch(list(repeated_in_block(block)), [pa.int64(), pa.int32(), pa.int32()], RANGES.names)

    return dealt.mapInArrow(run, RANGES)


def repeated_by_count(with_bytes: DataFrame) -> DataFrame:
    """Repeated ranges among the stretches of anchors that have very many, by counting every string's hash."""
    schema = StructType(
        [
            StructField("one", LongType()),
            StructField("two", LongType()),
            StructField("key", LongType()),
            StructField("start", IntegerType()),
            StructField("times", LongType()),
        ]
    )

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                for row in batch.to_pylist():
                    data = np.frombuffer(row["bytes"], np.uint8)
                    one = window_hashes(data, LENGTH).view(np.int64)
                    two = window_hashes(data, LENGTH, OTHER_FACTOR).view(np.int64)
                    n = len(one)
                    starts = np.arange(row["start"], row["start"] + n, dtype=np.int32)
                    columns = [one, two, np.full(n, row["key"]), starts, np.full(n, row["times"])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema.names)

    strings = materialize(with_bytes.mapInArrow(run, schema), "strings")
    often = strings.groupBy("one", "two").agg(F.sum("times").alias("n")).where("n > 1").drop("n")
    found = strings.where("times = 1").join(often, ["one", "two"])
    return found.select("key", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_ranges(keyed: DataFrame) -> DataFrame:
    """(key, start, end) byte ranges that cover every repeated string; they may overlap."""
    all_stretches = materialize(stretches(keyed), "stretches")
    anchors = (
        all_stretches.groupBy("anchor")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.min("content") != F.max("content")).alias("differ"),
            F.max("again").alias("inner"),
        )
        .where("n > 1 OR inner")
    )
    anchors = materialize(anchors.drop("n"), "anchors")
    # Most stretches meet no other one and travel no further; the join leaves out the few that come along.
    likely = among(all_stretches, "anchor", anchors.select(F.col("anchor").alias("id")))
    met = materialize(likely.join(anchors, "anchor"), "met")
    end = (F.col("start") + F.col("starts") + (LENGTH - 1)).alias("end")
    plain = met.where("NOT differ AND NOT inner").select("key", "start", end)

    mixed = met.where("differ OR inner")
    place = F.min(F.struct("key", "start", "starts", "at", "again")).alias("place")
    distinct = mixed.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("times"), place)
    distinct = materialize(distinct.select("anchor", "content", "times", "place.*"), "distinct")
    often = distinct.where("times > 1").select("anchor", "content")
    copied = mixed.join(often, ["anchor", "content"]).select("key", "start", end)

    crowds = distinct.groupBy("anchor").agg((F.count(F.lit(1)) > MANY).alias("crowd"))
    wanted = distinct.join(crowds, "anchor").groupBy("key").agg(
        F.collect_list(F.struct("anchor", "content", "times", "start", "starts", "at", "again", "crowd")).alias("wanted")
    )
    cut = StructType(
        [*STRETCHES.fields, StructField("times", LongType()), StructField("crowd", BooleanType()), StructField("bytes", BinaryType())]
    )

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for key, pack, wanted in zip(*(batch.column(c) for c in ("key", "packed", "wanted"))):
                raw, rows = unpack(pack.as_py()), []
                for w in wanted.as_py():
                    piece = raw[w["start"] : w["start"] + w["starts"] + LENGTH - 1]
                    head = (w["anchor"], w["content"], key.as_py(), w["start"], w["starts"], w["at"], w["again"])
                    rows.append((*head, w["times"], w["crowd"], piece))
                yield _batch(rows, [*_ARROW, pa.int64(), pa.bool_(), pa.binary()], cut.names)

    with_bytes = materialize(packed(keyed).join(wanted, "key").mapInArrow(run, cut).dropDuplicates(["anchor", "content"]), "cut")
    ordered = repeated_by_order(with_bytes.where("NOT crowd"))
    counted = repeated_by_count(with_bytes.where("crowd"))
    return plain.unionByName(copied).unionByName(ordered).unionByName(counted)


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[list[int]] = []
    for r in sorted((r["start"], r["end"]) for r in ranges):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [tuple(r) for r in out]


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes) and, if kept, ``text``: what is
    left as text, where a character that lost only some of its bytes is dropped."""
    added = [
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
        StructField("kept_sha256", StringType()),
    ] + ([StructField("text", StringType())] if keep_text else [])
    names = {f.name for f in added} | {"key", "text", "packed", "ranges"}
    others = [c for c in docs.columns if c not in names]
    keyed = docs.select(*others, "text").withColumn("key", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    ranges = repeated_ranges(keyed.select("key", "text"))
    by_key = ranges.distinct().groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = packed(keyed).join(by_key, "key", "left").drop("key")
    schema = StructType([docs.schema[c] for c in others] + added)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            made = []
            for pack, found in zip(batch.column("packed"), batch.column("ranges")):
                raw, spans = unpack(pack.as_py()), merged(found.as_py() or [])
                kept, at = [], 0
                for begin, end in spans:
                    kept.append(raw[at:begin])
                    at = end
                left = b"".join([*kept, raw[at:]])
                row = (len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest())
                made.append((*row, left.decode(errors="ignore")) if keep_text else row)
            columns = list(zip(*made)) or [()] * len(added)
            arrays = [batch.column(c).cast(arrow.field(c).type) for c in others]
            arrays += [pa.array(c, arrow.field(f.name).type) for c, f in zip(columns, added)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return joined.mapInArrow(run, schema)
