"""Packing of tokenised documents into sequences of a fixed length by linear grouping.

Only the histogram of piece lengths, which has one entry for each length up to the capacity, is planned on the driver:

1. large lengths are put into groups of equal cardinality, and each is rounded up to the largest of its group;
2. the few rounded sizes are covered with as few configurations (multisets that fit one sequence) as a linear program
   over them needs; its columns come from a knapsack over the dual prices;
3. real documents take the rounded places, so every sequence has at least the room that was planned;
4. the small lengths, the longest first, go to the fullest sequence that still has room.

Each length then has a list of intervals of ranks, and an interval's sequence numbers and offsets follow from the rank
by division. Documents get their rank among those of one length from counts by task, so none is moved by its length.

* A null text is an empty text, which has the end token alone.
* Repeated rows and repeated or null ids are packed as often as they occur; an empty table gives no rows.
* Only documents longer than a sequence are cut; whole texts are tokenised.
* Other columns of ``docs`` do not matter, also if they are named like one of the result.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections import defaultdict
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from vecflow.llm.common import Bounded, slices, texts_of
from vecflow.scratch import materialize

CAPACITY = 4096
END_TOKEN = np.array([1], "<u4").tobytes()
#: Lengths above this share of the capacity are large; they are put into so many groups.
LARGE_SHARE, GROUPS = 1 / 8, 40


# ---------------------------------------------------------------- tokens

#: The vocabulary's rule for pre-tokens (a fixed value), and the same for texts without unusual characters.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_]+|\\d|(?:[^\\w\\s]|_)+")
#: Anything but printable ASCII, plain white space and precomposed Latin letters.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ž]|<\\|")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens:
    """Token ids of texts for a vocabulary whose merges stay within its pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        rules = json.loads(self.library.to_str())
        if rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError(f"{path} splits words by another rule")
        self.model = self.library.model
        self.known = Bounded(self._ids, 200_000)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.byte_chars = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}

    def _ids(self, part: str) -> bytes:
        as_bytes = part if part.isascii() else part.encode().decode("latin-1").translate(self.byte_chars)
        return pack_ids([t.id for t in self.model.tokenize(as_bytes)])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids. Texts with unusual characters go through the whole library."""
        if UNUSUAL.search(text):
            return pack_ids(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.known.__getitem__, PARTS.findall(text.lower())))


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


PIECES = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("piece", IntegerType()),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
        StructField("task", IntegerType()),
        StructField("rank", LongType()),
    ]
)


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, with its rank among the pieces of its length that the same task made."""

    def run(batches):
        tokens, task = word_tokens(path), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        arrow = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = tokens.encode(text) + END_TOKEN
                for number, start in enumerate(range(0, len(ids) // 4, capacity)):
                    cut = ids[4 * start : 4 * (start + capacity)]
                    length = len(cut) // 4
                    rows.append((doc_id, number, start, length, zlib.crc32(cut), task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows)) or [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow)], PIECES.names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the plan


@dataclass
class Run:
    """So many sequences, numbered from ``first``, with the same filling."""

    first: int
    count: int
    free: int


@dataclass
class Plan:
    """Where the pieces of each length go; intervals of ranks in ascending order."""

    capacity: int
    sequences: int = 0
    taken: dict[int, int] = field(default_factory=lambda: defaultdict(int))
    intervals: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, each, first, offset

    def place(self, length: int, run: Run, each: int) -> None:
        """``each`` pieces of a length into every sequence of a run."""
        self.intervals.append((length, self.taken[length], each, run.first, self.capacity - run.free))
        self.taken[length] += run.count * each
        run.free -= each * length

    def new_run(self, count: int) -> Run:
        run = Run(self.sequences, count, self.capacity)
        self.sequences += count
        return run


def linear_groups(histogram: dict[int, int], groups: int) -> list[dict[int, int]]:
    """Lengths in descending order, cut into groups of equal cardinality (a length may belong to two)."""
    total, made = sum(histogram.values()), []
    quota = -(-total // groups) if total else 0
    current: dict[int, int] = {}
    room = quota
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            part = min(left, room)
            current[length] = current.get(length, 0) + part
            left, room = left - part, room - part
            if not room:
                made.append(current)
                current, room = {}, quota
    return made + ([current] if current else [])


def best_configuration(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset that fits the capacity and has the highest price, by dynamic programming."""
    value, layers = np.zeros(capacity + 1), []  # the highest price within each space, by the number of members
    for _ in range(capacity // min(sizes)):
        longer, choice = value.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            worth = value[: capacity + 1 - size] + prices[i]
            better = worth > longer[size:] + 1e-12
            longer[size:][better] = worth[better]
            choice[size:][better] = i
        layers.append(choice)
        value = longer
    found, space = np.zeros(len(sizes)), capacity
    for choice in reversed(layers):
        if (i := choice[space]) >= 0:
            found[i] += 1
            space -= sizes[i]
    return float(value[capacity]), found


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often the linear program over them uses each: min sum x, A x >= counts."""
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(counts, float)
    amounts = need / np.diag(basis)
    for _ in range(40 * len(sizes)):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, column = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if worth <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, column)
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        amounts = np.maximum(amounts - ratios[leaving] * direction, 0)
        amounts[leaving] = ratios[leaving]
        basis[:, leaving] = column
    return [(basis[:, i], float(amounts[i])) for i in range(len(sizes)) if amounts[i] > 1e-9]


def pack_large(plan: Plan, histogram: dict[int, int], groups: int) -> list[Run]:
    """Sequences with the large lengths; the places of a group are taken by its lengths, the longest first."""
    grouped = linear_groups(histogram, groups)
    if not grouped:
        return []
    merged: dict[int, dict[int, int]] = {}
    for group in grouped:
        lengths = merged.setdefault(max(group), defaultdict(int))
        for length, n in group.items():
            lengths[length] += n
    sizes = sorted(merged, reverse=True)
    waiting = {s: sorted(merged[s].items(), reverse=True) for s in sizes}
    left = {s: sum(merged[s].values()) for s in sizes}
    runs: list[Run] = []

    def use(configuration: np.ndarray, times: int) -> None:
        run = plan.new_run(times)
        open_runs = [run]
        for i, size in enumerate(sizes):
            for _ in range(int(round(configuration[i]))):
                todo, open_runs = open_runs, []
                for part in todo:
                    while part.count and waiting[size]:
                        length, n = waiting[size][0]
                        taken = Run(part.first, min(n, part.count), part.free)
                        plan.place(length, taken, 1)
                        left[size] -= taken.count
                        waiting[size][0] = (length, n - taken.count)
                        if n == taken.count:
                            waiting[size].pop(0)
                        open_runs.append(taken)
                        part = Run(part.first + taken.count, part.count - taken.count, part.free)
                    if part.count:
                        open_runs.append(part)
        runs.extend(open_runs)

    counts = [left[s] for s in sizes]
    chosen = configurations(sizes, counts, plan.capacity)
    for configuration, amount in chosen:  # whole parts of the program's solution, never more than is left
        times = min([int(amount)] + [left[s] // int(c) for s, c in zip(sizes, np.round(configuration)) if c >= 1])
        if times:
            use(configuration, times)
    for size in sizes:  # what rounding left: each goes to the fullest sequence that has room
        for length, n in waiting[size]:
            best_fit(plan, runs, {length: n})
        left[size] = 0
    return runs


def best_fit(plan: Plan, runs: list[Run], histogram: dict[int, int]) -> None:
    """Put pieces, the longest first, into the fullest sequences with room, then into new ones."""
    rooms: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        rooms[run.free].append(run)
    order = sorted(rooms)

    def back(run: Run) -> None:
        if run.free not in rooms or not rooms[run.free]:
            if (at := bisect.bisect_left(order, run.free)) == len(order) or order[at] != run.free:
                order.insert(at, run.free)
        rooms[run.free].append(run)

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                each = plan.capacity // length
                run = plan.new_run(max(1, n // each))
                runs.append(run)
            else:
                free = order[at]
                run = rooms[free].pop()
                if not rooms[free]:
                    order.pop(at)
                each = free // length
            full = min(run.count, n // each)
            if not full:  # the last sequence takes fewer
                full, each = 1, n
            if full < run.count:
                rest = Run(run.first + full, run.count - full, run.free)
                run.count = full
                runs.append(rest)
                back(rest)
            plan.place(length, run, each)
            n -= full * each
            back(run)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """A plan for so many pieces of each length."""
    plan = Plan(capacity)
    large = {n: c for n, c in histogram.items() if n > capacity * LARGE_SHARE}
    runs = pack_large(plan, large, groups)
    best_fit(plan, runs, {n: c for n, c in histogram.items() if n not in large})
    return plan


# ---------------------------------------------------------------- documents


PLACES = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The tokenised pieces are written to the shared folder once, so a lost executor never changes a rank.
    """
    pieces = materialize(tokenised_pieces(docs, path, capacity), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(histogram, capacity, groups)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["length", "task"])

    # at most a few intervals for each length, however many documents there are
    table = np.array(sorted(plan.intervals), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 44) + table[:, 1]
    result = StructType(PIECES.fields[:5] + PLACES.fields)

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("before").to_numpy()
            found = table[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            index = rank - found[:, 1]
            sequence = found[:, 3] + index // found[:, 2]
            offset = found[:, 4] + index % found[:, 2] * length
            kept = [batch.column(f.name) for f in PIECES.fields[:5]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], result.names)

    return ranked.mapInArrow(place, result)
