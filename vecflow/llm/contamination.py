"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

An item's fingerprint has 128 bits, each the sign of the summed bits of its five-word shingles. A document's windows
have the number of words of some item. A window and an item of that size are candidates if their fingerprints differ
in at most ``RADIUS`` bits; as the bits are cut into ``BLOCKS`` blocks of eight, two such fingerprints agree in some
block up to one bit, so looking up every block with its one-bit neighbours finds all of them. Candidates count if the
weighted Jaccard similarity of their shingles (weights are the numbers of occurrences) is at least ``SIMILARITY``.
Windows without any shingle of the item cannot reach that and get no fingerprint.

Items are the stated query set. They are taken in blocks of bounded size, one pass over the documents for each.

* Words are runs of letters and digits in lower case. Null texts and texts without words match nothing, and so do such
  items; a text shorter than an item is one window. Items of fewer than five words have one shingle.
* Of several windows for one item the most similar counts, the first of equals. Repeated rows match independently.
* Empty tables give no rows. Other columns do not matter; columns of ``docs`` named ``hits`` are replaced.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from vecflow.llm.common import map_texts, texts_of, word_hash
from vecflow.llm.near_copies import SHINGLE, shingles

SIMILARITY = 0.8
RADIUS, BLOCKS = 31, 16
#: Items of one pass at most.
ITEMS = 10_000
WORDS = re.compile(r"[^\W_]+")
FILTER_BITS = 22
HIT = StructType(
    [
        StructField("item_id", LongType()),
        StructField("start_word", IntegerType()),
        StructField("n_words", IntegerType()),
        StructField("distance", IntegerType()),
        StructField("similarity", DoubleType()),
    ]
)


def words_of(text: str) -> np.ndarray:
    return np.fromiter(map(word_hash.__getitem__, WORDS.findall(text.lower())), np.uint64)


def signs(values: np.ndarray) -> np.ndarray:
    """128 bits of each shingle as +1 and -1."""
    second = (values ^ (values >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    second ^= second >> np.uint64(32)
    both = np.stack([values, second], 1).astype("<u8").view(np.uint8)
    return np.unpackbits(both, axis=1).astype(np.int32) * 2 - 1


def fingerprints(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """One row of 16 bytes for each window of ``size`` shingles from the given starts on."""
    low, high = int(starts.min()), int(starts.max()) + size
    sums = np.zeros((high - low + 1, 128), np.int32)
    np.cumsum(signs(values[low:high]), axis=0, out=sums[1:])
    return np.packbits(sums[starts - low + size] > sums[starts - low], axis=1)


def weighted_similarity(a: Counter, b: Counter) -> float:
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Items:
    """A block of benchmark items with its fingerprint index."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.sizes, self.counts = [], [], []
        self.with_shingle: dict[int, list[int]] = defaultdict(list)
        self.blocks: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        prints = []
        for item_id, text in items:
            words = words_of(text or "")
            if not len(words):
                continue
            values, number = shingles(words), len(self.ids)
            self.ids.append(item_id)
            self.sizes.append(len(words))
            self.counts.append(Counter(values.tolist()))
            for value in self.counts[-1]:
                self.with_shingle[value].append(number)
            print_ = fingerprints(values, np.zeros(1, np.int64), len(values))[0]
            prints.append(print_)
            for block, byte in enumerate(print_.tolist()):
                for near in [byte, *(byte ^ (1 << bit) for bit in range(8))]:
                    self.blocks[len(words)][block, near].append(number)
        self.prints = np.array(prints, np.uint8).reshape(-1, BLOCKS)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        if self.with_shingle:
            self.filter[np.fromiter(self.with_shingle, np.uint64) & np.uint64((1 << FILTER_BITS) - 1)] = True

    def hits(self, text: str) -> list[tuple]:
        words = words_of(text)
        if not len(words) or not self.ids:
            return []
        windows: dict[int, set[int]] = defaultdict(set)  # first words of the windows of each size
        by_length: dict[int, np.ndarray] = {}
        if self.short:
            for length in range(1, min(SHINGLE, len(words) + 1)):
                by_length[length] = self._shingles(words, length)
        if len(words) >= SHINGLE:
            by_length[SHINGLE] = shingles(words)
        for length, values in by_length.items():
            maybe = np.flatnonzero(self.filter[values & np.uint64((1 << FILTER_BITS) - 1)])
            for at, value in zip(maybe.tolist(), values[maybe].tolist()):
                for number in self.with_shingle.get(value, ()):
                    size = min(self.sizes[number], len(words))
                    if min(size, SHINGLE) == length:
                        first = max(0, at - (size - length))
                        windows[self.sizes[number]].update(range(first, min(at, len(words) - size) + 1))
        best: dict[int, tuple] = {}
        for item_size, starts_of in windows.items():
            size = min(item_size, len(words))
            values = by_length[min(size, SHINGLE)]
            n, starts, index = size - min(size, SHINGLE) + 1, np.array(sorted(starts_of)), self.blocks[item_size]
            prints = fingerprints(values, starts, n)
            for start, bytes_ in zip(starts.tolist(), prints):
                found = {x for key in enumerate(bytes_.tolist()) for x in index.get(key, ())}
                for number in found:
                    distance = int(np.bitwise_count(self.prints[number] ^ bytes_).sum())
                    if distance > RADIUS:
                        continue
                    similarity = weighted_similarity(Counter(values[start : start + n].tolist()), self.counts[number])
                    if similarity >= SIMILARITY and (number not in best or similarity > best[number][4]):
                        best[number] = (self.ids[number], start, size, distance, similarity)
        return sorted(best.values(), key=lambda hit: (hit[0] is None, hit[0], hit[1]))

    @property
    def short(self) -> bool:
        return min(self.sizes, default=SHINGLE) < SHINGLE

    @staticmethod
    def _shingles(words: np.ndarray, length: int) -> np.ndarray:
        """Shingles of fewer than five words, for short items; hashed like a whole short text."""
        return np.concatenate([shingles(words[i : i + length]) for i in range(len(words) - length + 1)])


def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``hits``, an array with one entry for each item found in the document."""
    numbered = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").withColumn(
        "block", F.floor((F.row_number().over(Window.orderBy("item_id", "text")) - 1) / ITEMS)
    )
    blocks = (numbered.agg(F.max("block")).first()[0] or 0) + 1
    out = docs.drop("hits").withColumn("hits", F.array().cast(ArrayType(HIT)))
    for block in range(blocks):
        rows = numbered.where(F.col("block") == block).select("item_id", "text").collect()  # ITEMS at most
        sent = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
        out = _with_block(out, sent)
    return out


def _with_block(docs: DataFrame, sent) -> DataFrame:
    held: list[Items] = []

    def find(batch) -> dict:
        with np.errstate(over="ignore"):
            if not held:
                held.append(Items(sent.value))
            found = [[dict(zip(HIT.names, h)) for h in held[0].hits(t)] for t in texts_of(batch)]
        return {"more": found}

    made = map_texts(docs, find, [StructField("more", ArrayType(HIT))], docs.columns)
    return made.withColumn("hits", F.concat("hits", "more")).drop("more")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item found in it."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return with_hits(ids, benchmark).select("doc_id", F.inline("hits"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any item."""
    return with_hits(docs, benchmark).where(F.size("hits") == 0).drop("hits").select(*[c for c in docs.columns if c != "hits"])
