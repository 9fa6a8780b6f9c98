"""Alignment of two tokenizers over the same texts.

Tokens of two vocabularies are laid along the bytes of ``" " + text``. Where a token of both ends, a group ends; two
tokens are linked where their byte ranges overlap. How many documents hold a pair of ids linked is counted over the
whole corpus and joined back to the links of each document.

Both vocabularies cut a text before white space that follows a visible character and starts with a space or line feed,
so a stretch between such cuts is encoded and aligned alike wherever it stands. Each slice of texts is reduced to its
distinct stretches first; these are encoded, and Arrow does the rest in columns: token lists are flattened with their
parents, token lengths become ends by cumulative sums within a parent, a hash join on (parent, end) finds common ends,
and ``Table.group_by`` counts pairs by document and documents by pair. Spark adds the partial counts up.

* A null or empty text, and one whose tokens of either vocabulary do not spell ``" " + text``, has no tokens: zeros and
  an empty digest. Strings of special tokens are ordinary text.
* Each row is a document of its own, also where ids repeat or are null. An empty table gives no rows.
* Very long texts are cut at stretches and their parts added up; one stretch is never cut.
* Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecflow.llm.common import SLICE_CHARS, lookup, slices
from vecflow.scratch import materialize

#: White space and the visible run after it. Only a space or a line feed starts a new stretch.
STRETCH = re.compile(r"\s*\S+(?:[^\S \n]\s*(?:\S+|\Z))*|\s+")
CUT = re.compile(r"(?<=\S)[ \n]")
#: An ordinary first stretch, so that what a library puts before a text never touches the stretches after it.
OPENING = " a"
#: Stretches that are encoded as one text.
TOGETHER = 2_000
#: Ids of the second vocabulary lie below this number in a pair.
PAIR_BASE = 1 << 24
#: What a piece vocabulary writes for a space; a text that holds it itself is not spelled by its pieces.
SPACE_MARK = "▁"

#: A pair that holds this part of all pairs of all documents is broadcast with its count; so at most this many are.
HOT_PAIRS = 100_000

#: What is known of a document without tokens, from ``n_a`` on.
NOTHING = (0, 0, 0, 0, "", [], [], False)
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
MADE = (
    "row bigint, doc_id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<int>, partial boolean"
)


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        shown = {c: bytes([b]) for b, c in byte_characters().items()}
        size = self.library.get_vocab_size()
        names = [self.library.id_to_token(i) or "" for i in range(size)]
        self.token_bytes = pa.array([b"".join(shown.get(c, c.encode()) for c in name) for name in names], pa.binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A piece vocabulary of the sentencepiece library, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.token_bytes = pa.array(
            [bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(SPACE_MARK, " ").encode() for i, n in enumerate(names)],
            pa.binary(),
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode([t[1:] for t in texts], num_threads=1)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def bytes_of(tokens: pa.Array) -> np.ndarray:
    """All bytes of a binary or string array without nulls, one after the other."""
    _, offsets, values = tokens.buffers()
    bounds = np.frombuffer(offsets, np.int32)[tokens.offset : tokens.offset + len(tokens) + 1]
    return np.frombuffer(values, np.uint8)[bounds[0] : bounds[-1]] if values is not None else np.zeros(0, np.uint8)


def ends_of(ids: pa.ListArray, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Parent and end of every token; an end counts bytes from the start of its parent."""
    parent = pc.list_parent_indices(ids)
    running = pc.cumulative_sum(pc.cast(pc.binary_length(tokens), pa.int64()))
    totals = pa.array(np.concatenate([[0], running.to_numpy()]))
    before = totals.take(ids.offsets[:-1])  # what all earlier parents hold
    return parent.to_numpy(), pc.subtract(running, before.take(parent)).to_numpy()


@dataclass
class Aligned:
    """The alignment of some stretches: sums for each, its links as pairs of ids, and its groups as text."""

    sums: np.ndarray  # a row of COUNTS for each stretch
    links: pa.ListArray
    groups: pa.Array
    valid: np.ndarray


def lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    """Consecutive values as lists of the given sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def joined(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pc.binary_join(lists(pc.cast(pa.array(ids), pa.string()), sizes), ",")


def align(a: pa.Table, b: pa.Table, n: int) -> Aligned:
    """The alignment of ``n`` parents whose tokens spell the same bytes, and end where the parent ends."""
    keys = ["parent", "end"]
    a = a.rename_columns(["parent", "end", "a"]).append_column("at_a", pa.array(np.arange(a.num_rows)))
    b = b.rename_columns(["parent", "end", "b"]).append_column("at_b", pa.array(np.arange(b.num_rows)))
    both = a.join(b, keys, join_type="full outer", use_threads=False).sort_by([(k, "ascending") for k in keys])
    # A row is a stretch of bytes without an inner end, so it belongs to one token of each side: the next that ends.
    common = pc.and_(pc.is_valid(both["at_a"]), pc.is_valid(both["at_b"])).to_numpy()
    of_a, of_b = (pc.fill_null_backward(both[c]).combine_chunks() for c in ("a", "b"))
    parent = both["parent"].to_numpy()
    pairs = pc.add(pc.multiply(pc.cast(of_a, pa.int64()), PAIR_BASE), pc.cast(of_b, pa.int64()))

    group = np.cumsum(common) - common  # ends of groups before this row: the number of its group
    n_groups = int(common.sum())
    ends_a, ends_b = pc.is_valid(both["at_a"]).to_numpy(), pc.is_valid(both["at_b"]).to_numpy()
    in_group = [np.bincount(group[ends], minlength=n_groups) for ends in (ends_a, ends_b)]
    texts = [joined(ids.to_numpy()[ends], sizes) for ids, ends, sizes in zip((of_a, of_b), (ends_a, ends_b), in_group)]
    in_parent = [np.bincount(parent[which], minlength=n) for which in (ends_a, ends_b, common, slice(None))]
    groups = pc.binary_join(lists(pc.binary_join_element_wise(*texts, "|"), in_parent[2]), ";")
    return Aligned(np.stack(in_parent, 1), lists(pairs, in_parent[3]), groups, np.ones(n, bool))


def tokens_by_stretch(stretches: list[str], texts: list[list[int]], vocabularies: tuple) -> tuple[np.ndarray, list[pa.Table]]:
    """Which texts (lists of stretches) both vocabularies spell, and the tokens of those by stretch.

    A text counts only if its tokens spell it and none reaches over the bounds of a stretch, so a wrong cut is seen.
    """
    inner = [[OPENING, *(stretches[i] for i in members)] for members in texts]
    sizes = np.array([len(s.encode()) for part in inner for s in part], np.int64)
    owner = np.array([i for members in texts for i in (-1, *members)], np.int64)
    text_of = np.repeat(np.arange(len(texts)), [len(part) for part in inner])
    closes = np.cumsum(sizes)
    whole = ["".join(part) for part in inner]
    lengths = np.bincount(text_of, sizes, len(texts)).astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    wanted, good, found = np.frombuffer("".join(whole).encode(), np.uint8), np.ones(len(texts), bool), []
    for vocabulary in vocabularies:
        ids = pa.array(vocabulary.encode(whole), pa.list_(pa.int32()))
        flat = pc.list_flatten(ids)
        tokens = vocabulary.token_bytes.take(flat)
        parent, end = ends_of(ids, tokens)
        at = begins[parent] + end
        made, made_lengths = bytes_of(tokens), np.zeros(len(texts), np.int64)
        np.maximum.at(made_lengths, parent, end)
        if len(made) != len(wanted) or not np.array_equal(made, wanted):
            starts = np.cumsum(made_lengths) - made_lengths
            for i, n in enumerate(lengths):
                same = n == made_lengths[i]
                good[i] &= same and np.array_equal(made[starts[i] : starts[i] + n], wanted[begins[i] : begins[i] + n])
        good &= np.bincount(text_of[~np.isin(closes, at)], minlength=len(texts)) == 0
        found.append((parent, at, flat.to_numpy()))
    tables = []
    for parent, at, ids in found:
        kept = good[parent]
        at, ids = at[kept], ids[kept]
        place = np.searchsorted(closes, at)
        stretch, end = owner[place], at - closes[place] + sizes[place]
        own = stretch >= 0
        tables.append(pa.table({"parent": stretch[own], "end": end[own], "token": ids[own]}))
    return good, tables


def align_stretches(stretches: list[str], vocabularies: tuple) -> Aligned:
    """The alignment of distinct stretches. Those that either vocabulary does not spell get no tokens."""
    together = [i for i, s in enumerate(stretches) if not s[-1].isspace() and SPACE_MARK not in s]
    alone = sorted(set(range(len(stretches))) - set(together))
    texts = [together[i : i + TOGETHER] for i in range(0, len(together), TOGETHER)] + [[i] for i in alone]
    valid, tables = np.zeros(len(stretches), bool), []
    while texts:
        good, made = tokens_by_stretch(stretches, texts, vocabularies)
        tables.append(made)
        valid[[i for ok, members in zip(good, texts) if ok for i in members]] = True
        texts = [[i] for ok, members in zip(good, texts) if not ok and len(members) > 1 for i in members]
    aligned = align(*(pa.concat_tables(side) for side in zip(*tables)), len(stretches))
    aligned.valid = valid
    return aligned


def parts_of(text: str, limit: int) -> Iterator[str]:
    """``" " + text`` in parts of about ``limit`` characters, cut between stretches."""
    text, start = " " + text, 0
    while len(text) - start > limit:
        cut = CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


@dataclass
class Document:
    """What is known of a text while its parts are aligned."""

    sums: np.ndarray
    valid: bool
    digest: object
    begun: bool
    pairs: list


def align_slice(parts: list[tuple[int, str]], both: tuple) -> Iterator[tuple[int, np.ndarray, bool, str, pa.Array, pa.Array]]:
    """For each (row, part): sums, whether it is spelled, its groups as text, and its pairs with their numbers."""
    found = [STRETCH.findall(text) for _, text in parts]
    sizes = np.array([len(f) for f in found])
    coded = pa.array([s for f in found for s in f], pa.large_string()).dictionary_encode()
    del found
    aligned = align_stretches(coded.dictionary.to_pylist(), both)
    codes = coded.indices.to_numpy()
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.add.reduceat(aligned.sums[codes], bounds[:-1], axis=0)
    valid = np.logical_and.reduceat(aligned.valid[codes], bounds[:-1])
    texts = pc.binary_join(lists(aligned.groups.take(coded.indices), sizes), ";")
    n_links = sums[:, 3]
    table = pa.table({
        "part": np.repeat(np.arange(len(parts)), n_links),
        "pair": pc.list_flatten(aligned.links.take(coded.indices)),
    })
    counted = table.group_by(["part", "pair"], use_threads=False).aggregate([([], "count_all")]).sort_by("part")
    starts = np.searchsorted(counted["part"].to_numpy(), np.arange(len(parts) + 1))
    pairs, times = counted["pair"].combine_chunks(), counted["count_all"].combine_chunks()
    for i, (row, _) in enumerate(parts):
        span = slice(starts[i], starts[i + 1])
        yield row, sums[i], bool(valid[i]), texts[i].as_py(), pairs[span], times[span]


def aligned_rows(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, schema: pa.Schema, limit: int) -> Iterator[pa.RecordBatch]:
    """One row for each document, and after each slice one with partial counts of documents by pair."""
    both = vocabularies(path_a, path_b)
    number = TaskContext.get().partitionId() << 33
    waiting: list[tuple[int, object, str, bool]] = []  # (row, id, part, last part)

    def run() -> Iterator[pa.RecordBatch]:
        nonlocal waiting
        rows, tables = [], []
        for (row, doc_id, _, last), made in zip(waiting, align_slice([(w[0], w[2]) for w in waiting], both)):
            _, sums, valid, text, pairs, times = made
            state = open_documents.setdefault(row, Document(np.zeros(4, np.int64), True, hashlib.sha256(), False, []))
            state.sums = state.sums + sums
            state.valid &= valid
            state.digest.update(((";" if state.begun else "") + text).encode())
            state.begun = True
            state.pairs.append(pa.table({"pair": pairs, "times": times}))
            if last:
                rows.append((row, doc_id, open_documents.pop(row)))
        out = []
        for row, doc_id, state in rows:
            if not state.valid:
                out.append((row, doc_id, *NOTHING))
                continue
            pairs = state.pairs[0]
            if len(state.pairs) > 1:
                pairs = pa.concat_tables(state.pairs).group_by("pair", use_threads=False).aggregate([("times", "sum")])
                pairs = pairs.rename_columns(["pair", "times"])
            tables.append(pairs)
            values = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (pairs["pair"], pairs["times"])]
            out.append((row, doc_id, *map(int, state.sums), state.digest.hexdigest(), *values, False))
        if tables:
            held = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            out.append((None, None, None, None, None, None, None, held["pair"].combine_chunks(), held["count_all"].combine_chunks(), True))
        waiting = []
        if out:
            yield record(out)

    def record(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([column(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def column(values: list, data_type: pa.DataType) -> pa.Array:
        if not pa.types.is_list(data_type):
            return pa.array(values, data_type)
        sizes = np.array([len(v) for v in values])
        arrays = [pa.array(v, data_type.value_type) if isinstance(v, list) else v.cast(data_type.value_type) for v in values]
        return lists(pa.concat_arrays(arrays), sizes).cast(data_type)

    open_documents: dict[int, Document] = {}
    gathered = 0
    for batch in slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                yield record([(number, doc_id, *NOTHING)])
                number += 1
                continue
            parts = list(parts_of(text, limit))
            for i, part in enumerate(parts):
                if waiting and gathered + len(part) > limit:
                    yield from run()
                    gathered = 0
                waiting.append((number, doc_id, part, i == len(parts) - 1))
                gathered += len(part)
            number += 1
    if waiting:
        yield from run()


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, limit: int = SLICE_CHARS) -> DataFrame:
    """The written table of ``MADE``: a row for each document and rows of partial counts by pair."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select("doc_id", "text")
    schema = StructType.fromDDL(MADE.format(id=rows.schema["doc_id"].dataType.simpleString()))
    arrow = to_arrow_schema(schema)
    return materialize(rows.mapInArrow(lambda batches: aligned_rows(batches, path_a, path_b, arrow, limit), schema), "aligned")


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents a pair of ids is linked, and whether that is its first id's highest."""
    partial = made.where("partial").select(F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    counts = partial.groupBy(F.col("held.pairs").alias("pair")).agg(F.sum("held.times").alias("docs"))
    counts = materialize(counts, "pairs")
    first = F.floor(F.col("pair") / PAIR_BASE).cast("int")
    highest = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("highest"))
    best = (F.col("docs") == F.col("highest")).alias("best")
    return materialize(counts.withColumn("a", first).join(highest, "a").select("pair", "docs", best), "pairs")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``."""
    made = aligned_documents(docs, path_a, path_b)
    documents = made.where("not partial")
    held = documents.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("held"))
    held = held.select("row", F.col("held.pairs").alias("pair"), F.col("held.times").alias("times"))
    counts = pair_counts(made)
    total = counts.agg(F.sum("docs")).first()[0] or 0
    sums = (
        lookup(held, counts, ["pair"], "docs", total, HOT_PAIRS)
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return documents.select("row", "doc_id", *COUNTS, "groups_sha256").join(sums, "row", "left").select(
        "doc_id", *COUNTS, *[F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")], "groups_sha256"
    )
