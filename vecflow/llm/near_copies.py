"""Near copies by ordered minimum sketches, verified by banded alignment of words.

A text's three-word shingles are labelled with the number of their occurrence. Each of ``SKETCHES`` hash functions picks
the two labelled shingles with the smallest values, and their hashes in text order are the key of one bucket: texts
share it if they share both shingles in the same order, so it follows the edit similarity rather than the set overlap.
Shingles of three words serve the search only; the alignment decides. Two texts that differ in a fifth of their words,
the limit, share a bucket with a chance of about 0.99 if the places are random, and of 0.95 if it is each fifth word
(simulated over texts of 30 and 400 words).

Exact copies (of the words) are one node from the start. In a bucket every node is first compared with the smallest id,
which a combining aggregation finds. Nodes of a bucket of three or more also meet in finer buckets, whose keys join
two and four neighbouring sketches, so similar texts meet although a shared passage brought unlike ones along.
Candidates are aligned word by word; they are linked if the edit distance is at most a fifth of the longer text.

What a bucket's smallest id has left apart is then compared pair by pair: each two members of a bucket that are of
different classes so far, however many there are. A bucket is cut into blocks, and a task compares two of them. Both texts'
words are counted in ``BINS`` bins; the surplus of one text over the other is never more than their edit distance, so a pair
with too large a surplus has no link and is not aligned. All others are, by rising surplus: of each two classes
``TRIED`` pairs first, then, in rounds, more of those that are still apart, until none is left. Links of these rounds join
classes, so the components of a round are found among the classes, not again among all nodes. So no link between two
texts that share a bucket is missed. The comparisons grow with the square of a bucket of unlike texts, which a passage brings
together that many texts have; they are spread over tasks, and a task holds two blocks.

* A null text, and one without words, is like no other: its class is its own id.
* A text of fewer than three words has one shingle, all its words.
* Rows that share an id are one document; where the id is null, the class is that of the text's other ids, else null.
* Ties go to the smallest id. An empty table gives no rows. Other columns of ``docs`` do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from vecflow.llm.common import SEPARATES, WORD, map_texts, slices, texts_of, values_of, word_hash
from vecflow.llm.components import components
from vecflow.scratch import TEXTS, materialize

SHINGLE, SEARCHED, SKETCHES, SIMILARITY = 5, 3, 48, 0.8
#: Pairs of one leader that a task gets at most; the leader's words go to each such share.
SHARE = 2_000
#: Bins in which a text's words are counted, members of a block, and pairs of two classes that are aligned first; each
#: further round aligns the square of ``TRIED`` times as many.
BINS, BLOCK, TRIED = 512, 2_000, 16
#: Bins that are looked at first, each of several of the others.
ROUGH = 64
#: Pairs that a task hands on at once.
SENT = 20_000
#: Values of the hash functions that are found at once, few enough for a processor's cache.
TOGETHER = 40_000
#: Words of the longest texts whose distance is found by whole columns; wider bands decide those of longer ones.
COLUMN = 50_000
#: Places for marks of the ids whose texts are compared: about this many for each id, and 16 MB of them at most.
MARKS_EACH, MARKS = 16, 1 << 27
_odd = np.random.default_rng(17)
MULTIPLIERS = _odd.integers(0, 2**63, SKETCHES, np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _odd.integers(0, 2**63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)

def hashed_words(text: str) -> np.ndarray:
    return np.fromiter(map(word_hash.__getitem__, WORD.findall(text.lower())), np.uint64)


def hashed_texts(texts: list[str]) -> list[np.ndarray]:
    """The hashes of the words of each text, all cut at once and each distinct word hashed once."""
    parts = [t.lower().encode() for t in texts]
    flat = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    word = ~SEPARATES[flat]
    before = np.r_[False, word[:-1]]
    opens = np.flatnonzero(word & ~before)
    offsets = np.r_[0, np.cumsum(np.flatnonzero(~word & before) - opens)]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat[word])]
    words = pa.Array.from_buffers(pa.large_binary(), len(opens), buffers).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, values_of(words.dictionary)), np.uint64, len(words.dictionary))
    ends = np.searchsorted(opens, np.cumsum([len(p) + 1 for p in parts]))
    return np.split(hashes[words.indices.to_numpy()], ends[:-1])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of ``size`` words; one for a shorter text."""
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * PLACE[i]
    return _mixed(total)


def occurrence_labelled(values: np.ndarray) -> np.ndarray:
    """Hashes in which equal shingles differ by the number of their occurrence."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    if len(starts) == len(values):
        return values
    numbers = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    labelled = values.copy()
    labelled[order] += numbers.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return labelled


def ordered_sketches(words: np.ndarray) -> np.ndarray:
    """One key per hash function, of the two smallest labelled shingles in text order."""
    plain = shingles(words, SEARCHED)
    labelled = _mixed(occurrence_labelled(plain))
    rows, step = np.arange(SKETCHES), max(1, TOGETHER // len(labelled))
    first, second = np.empty(SKETCHES, np.int64), np.empty(SKETCHES, np.int64)
    for at in range(0, SKETCHES, step):
        values = labelled[None, :] * MULTIPLIERS[at : at + step, None]
        values ^= values >> np.uint64(32)
        first[at : at + step] = values.argmin(1)
        values[rows[: len(values)], first[at : at + step]] = np.uint64(2**64 - 1)
        second[at : at + step] = values.argmin(1)
    left, right = np.minimum(first, second), np.maximum(first, second)
    return _mixed(plain[left] * MULTIPLIERS + _mixed(plain[right] + MULTIPLIERS))


def binned(words: np.ndarray) -> bytes:
    """How many words fall into each bin, up to 255."""
    return np.minimum(np.bincount((words % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of the words (null without words), their number, their bins, and the sketches."""
    added = [
        StructField("print", BinaryType()),
        StructField("n_words", LongType()),
        StructField("bins", BinaryType()),
        StructField("keys", ArrayType(LongType())),
    ]

    def sketch(batch) -> dict:
        out: dict = {"print": [], "n_words": [], "bins": [], "keys": []}
        with np.errstate(over="ignore"):
            for words in hashed_texts(texts_of(batch)):
                out["n_words"].append(len(words))
                out["print"].append(xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None)
                out["bins"].append(binned(words) if len(words) else None)
                out["keys"].append(ordered_sketches(words).view(np.int64) if len(words) else None)
        return out

    return map_texts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), sketch, added, ["doc_id"])


def candidates(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (leader, other) pairs of nodes (id, n_words, bins, keys) that meet in a bucket and have similar lengths, and
    the nodes of buckets of three or more, with ``places``: which of their sketches are keys of such buckets."""
    pairs = crowded = None
    buckets = nodes.select("id", "n_words", F.posexplode("keys").alias("j", "key"))
    for span in (1, 2, 4):
        found = buckets.groupBy("key").agg(
            F.count(F.lit(1)).alias("members"), F.min(F.struct("id", "n_words")).alias("leader")
        )
        met = buckets.join(found.where("members > 1"), "key").select("id", "n_words", "j", "members", "leader")
        if span < 4:  # read for the pairs and for the crowds
            met = materialize(met, "met")
        similar = F.least("n_words", "leader.n_words") >= SIMILARITY * F.greatest("n_words", "leader.n_words")
        made = met.where(F.col("id") != F.col("leader.id")).where(similar)
        made = made.select(F.col("leader.id").alias("leader"), F.col("id").alias("other"))
        pairs = made if pairs is None else pairs.unionByName(made)
        if span == 4:
            break
        crowds = met.where("members > 2").select("id", "j").distinct().groupBy("id").agg(F.collect_set("j").alias("places"))
        # The sketches of the nodes that are left travel once; later spans take them from there.
        from_nodes = nodes if crowded is None else crowded.drop("places")
        finer = materialize(from_nodes.hint("merge").join(crowds, "id").select("id", "n_words", "bins", "keys", "places"), "buckets")
        crowded = finer if crowded is None else crowded
        parts = [F.get("keys", (F.col("j") + i) % SKETCHES) for i in range(2 * span)]
        buckets = finer.select("id", "n_words", "keys", F.explode("places").alias("j"))
        buckets = buckets.select("id", "n_words", "j", F.xxhash64(F.lit(span), *parts).alias("key"))
    return pairs.distinct(), crowded


# ---------------------------------------------------------------- alignment


def least_distance(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: words that one text has more often than the other."""
    both, sign = np.concatenate([a, b]), np.r_[np.ones(len(a), np.int64), -np.ones(len(b), np.int64)]
    order = np.argsort(both)
    ordered = both[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    surplus = np.add.reduceat(sign[order], starts)
    return int(max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum()))


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without their common beginning and end, which an optimal alignment keeps."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n -= start
    if n:
        differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
        end = int(differ[0]) if len(differ) else n
        a, b = a[: len(a) - end], b[: len(b) - end]
    return a, b


def banded(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distances of pairs side by side, exact where at most ``band``. Lengths differ by at most ``band``."""
    width, count = 2 * band + 1, len(pairs)
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    rows = int(n.max(initial=0))
    left = np.zeros((count, rows), np.int64)
    right = np.full((count, rows + 2 * width), -1, np.int64)  # shifted by the band
    for i, (a, b) in enumerate(pairs):
        left[i, : len(a)] = a.view(np.int64) & 0x7FFFFFFFFFFFFFFF
        right[i, band : band + len(b)] = b.view(np.int64) & 0x7FFFFFFFFFFFFFFF
    steps = np.arange(width, dtype=np.int32)
    far = np.int32(1 << 29)
    row = np.where(steps >= band, steps - band, far)[None, :].repeat(count, 0).astype(np.int32)
    ends: dict[int, np.ndarray] = {int(v): np.flatnonzero(n == v) for v in np.unique(n)}
    distance = np.zeros(count, np.int64)

    def read(i: int) -> None:
        if (at := ends.get(i)) is not None:
            distance[at] = row[at, m[at] - i + band]

    read(0)
    for i in range(1, rows + 1):
        # entry k of a row is column i + k - band; the diagonal before is k, the one above is k + 1
        changed = row + (right[:, i - 1 : i - 1 + width] != left[:, i - 1 : i])
        np.minimum(changed[:, :-1], row[:, 1:] + 1, out=changed[:, :-1])
        if i <= band:
            changed[:, : band - i] = far
            changed[:, band - i] = i
        changed -= steps
        np.minimum.accumulate(changed, axis=1, out=changed)
        changed += steps
        row = changed.astype(np.int32, copy=False)
        read(i)
    return distance


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """The edit distance of two texts. A column of the table is two numbers, whose bits tell where it rises and falls."""
    if len(a) < len(b):
        a, b = b, a
    found: dict[int, int] = {}
    bit = 1
    for word in a.tolist():
        found[word] = found.get(word, 0) | bit
        bit <<= 1
    up = every = bit - 1
    down = 0
    for word in b.tolist():
        same = found.get(word, 0)
        either = same | down
        level = (((same & up) + up) ^ up) | same
        rises = (down | (every ^ (level | up))) << 1 | 1
        up = ((up & level) << 1 | (every ^ (either | rises))) & every
        down = rises & either
    return len(b) + up.bit_count() - down.bit_count()


def most_distance(a: np.ndarray, b: np.ndarray) -> int:
    """An upper bound of the edit distance: words that differ place by place, and those that one text has more."""
    n = min(len(a), len(b))
    return int(np.count_nonzero(a[:n] != b[:n])) + max(len(a), len(b)) - n


def close(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[bool]:
    """Whether each pair's edit distance is at most a fifth of the longer text. Where bounds leave it open, the distance
    decides; for long texts, bands that widen until it is known."""
    decided = [False] * len(pairs)
    waiting = []
    for i, (a, b) in enumerate(pairs):
        limit = int((1 - SIMILARITY) * max(len(a), len(b)) + 1e-9)
        a, b = trimmed(a, b)
        if abs(len(a) - len(b)) > limit:
            continue
        if most_distance(a, b) <= limit:
            decided[i] = True
        elif least_distance(a, b) <= limit:
            if max(len(a), len(b)) <= COLUMN:
                decided[i] = distance(a, b) <= limit
            else:
                waiting.append((len(a), i, limit, a, b))
    band = 4
    while waiting:
        now = sorted((w for w in waiting if abs(w[0] - len(w[4])) <= band), key=lambda w: w[:2])
        later = [w for w in waiting if abs(w[0] - len(w[4])) > band]
        while now:
            size = max(1, 400_000 // (2 * band + 1 + now[0][0]))
            part, now = now[:size], now[size:]
            if part[-1][0] > 2 * part[0][0] + 50:  # similar lengths go side by side
                cut = next(k for k, w in enumerate(part) if w[0] > 2 * part[0][0] + 50)
                part, now = part[:cut], part[cut:] + now
            for w, d in zip(part, banded([w[3:] for w in part], band)):
                if d <= band or band >= w[2]:
                    decided[w[1]] = bool(d <= w[2] and d <= band)
                else:
                    later.append(w)
        waiting, band = later, band * 4
    return decided


def places(column: str, size: int) -> Column:
    """The two places of an id."""
    return F.array(*(F.pmod(F.xxhash64(F.lit(i), column), F.lit(size)) for i in range(2)))


def marked(ids: DataFrame, size: int) -> np.ndarray:
    """A bit for each of ``size`` places, set where one of the ``ids`` has one of its two."""
    words = ids.select(F.explode(places("id", size)).alias("place")).groupBy(F.shiftright("place", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def held(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents whose id is in ``ids``, and of a few others at most: texts that no comparison wants
    are left out where they are read, and travel nowhere. The marks are bounded; the fuller they are, the more of the others
    come along."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    return materialize(among(rows, "doc_id", ids.distinct()), "texts", TEXTS)


def among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is in the distinct ``ids``, and a few others at most."""
    size = min(MARKS, 1 << max(6, (MARKS_EACH * ids.count()).bit_length()))
    sent = rows.sparkSession.sparkContext.broadcast(marked(ids, size))
    names = rows.columns

    def run(batches):
        marks = sent.value
        for batch in batches:
            at = batch.column("places").flatten().to_numpy().reshape(-1, 2)
            kept = ((marks[at >> 6] >> (at & 63)) & 1).all(1)
            yield batch.select(names).filter(pa.array(kept))

    return rows.withColumn("places", places(column, size)).mapInArrow(run, rows.schema)


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b) links of the candidate pairs that pass the alignment. Texts travel once to each share of a leader."""
    # The leaders of more than a share are few by that very number.
    large = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares")).where("shares > 1")
    share = F.pmod(F.xxhash64("other"), F.coalesce("shares", F.lit(1))).cast("int")
    placed = pairs.join(F.broadcast(large), "leader", "left").withColumn("share", share)
    others = placed.select(F.col("other").alias("doc_id"), "leader", "share", F.lit(1).alias("role"))
    leaders = placed.select("leader", "share").distinct()
    leaders = leaders.select(F.col("leader").alias("doc_id"), "leader", "share", F.lit(0).alias("role"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sent = texts.hint("merge").join(others.unionByName(leaders), "doc_id").repartition("leader", "share")
    sent = sent.sortWithinPartitions("leader", "share", "role", "doc_id")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("close", BooleanType())])

    def align(batches):
        leader, words = None, None
        for batch in slices(batches):
            waiting, ids = [], []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "leader", "role"))
            for doc_id, head, role, own in zip(*columns, hashed_texts(texts_of(batch))):
                if role == 0:
                    leader, words = head, own
                elif leader == head:
                    waiting.append((words, own))
                    ids.append((head, doc_id))
                    if sum(len(x) + len(y) for x, y in waiting[-1:]) > 100_000 or len(waiting) >= 4_000:
                        yield result(ids, close(waiting))
                        waiting, ids = [], []
            yield result(ids, close(waiting))

    def result(ids, found):
        a, b = zip(*ids) if ids else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(found, pa.bool_())], schema.names
        )

    return sent.mapInArrow(align, schema).where("close").select("a", "b")


# ---------------------------------------------------------------- the rest of the buckets


def unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("leader", "other").alias("low"), F.greatest("leader", "other").alias("high"))


def members(crowded: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, label, n_words, bins, keys, block, first, second): members of the buckets of three or more that hold several
    classes, once for each pair of blocks, ``first`` and ``second``, that a member's own ``block`` belongs to."""
    labelled = crowded.join(classes, "id", "left").withColumn("label", F.coalesce("component", "id"))
    found = labelled.select("id", "label", "keys", F.explode("places").alias("j"))
    found = materialize(found.select(F.get("keys", "j").alias("key"), "id", "label"), "members")
    sizes = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most"))
    mixed = sizes.where("least < most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = found.join(mixed, "key").join(crowded.select("id", "n_words", "bins", "keys"), "id")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second")]
    return placed.select("key", "id", "label", "n_words", "bins", "keys", "block", *cell)


def surplus(bins: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A lower bound of the edit distance of the texts ``i`` and ``j``."""
    differ = bins[i] - bins[j]
    more = np.maximum(differ, 0).sum(1)
    return np.maximum(more, more - differ.sum(1))


def apart(rows: DataFrame) -> DataFrame:
    """(low, high, bound, low_label, high_label): pairs of the members that are of different classes, with similar lengths and
    no surplus beyond the limit; each pair once."""
    order = ["key", "first", "second"]
    schema = StructType([StructField(c, LongType()) for c in ("low", "high", "bound", "low_label", "high_label")])

    def compared(held: list[pa.RecordBatch]):
        """The pairs of whole cells, in batches as they come up: a block of unlike texts may have millions."""
        table = pa.Table.from_batches(held).combine_chunks()
        cells = np.stack([table.column(c).to_numpy().astype(np.int64) for c in order])
        ids, label, n, block = (table.column(c).to_numpy() for c in ("id", "label", "n_words", "block"))
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
        rough = bins.reshape(len(bins), -1, ROUGH).sum(1, dtype=np.int16)
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(bins), -1)
        starts = np.flatnonzero(np.r_[True, (cells[:, 1:] != cells[:, :-1]).any(0)])
        ends = np.repeat(np.r_[starts[1:], len(ids)], np.diff(np.r_[starts, len(ids)]))
        within, alive, found, size = cells[1] == cells[2], np.arange(len(ids)), [], 0
        for step in range(1, len(ids)):  # each member with the one that many places on, in all cells at once
            alive = alive[alive + step < ends[alive]]
            alive = alive[n[alive] >= SIMILARITY * n[alive + step]]  # those that come after are no shorter
            if not len(alive):
                break
            other = alive + step
            wanted = (label[alive] != label[other]) & (within[alive] | (block[alive] != block[other]))
            i, j = alive[wanted], other[wanted]
            limit = ((1 - SIMILARITY) * n[j] + 1e-9).astype(np.int64)
            near = surplus(rough, i, j) <= limit
            i, j, limit = i[near], j[near], limit[near]
            # A pair that shares several keys is compared under the first of them only.
            same = keys[i] == keys[j]
            here = (keys[i, same.argmax(1)] == cells[0, i]) | ~same.any(1)
            i, j, limit = i[here], j[here], limit[here]
            bound = surplus(bins, i, j)
            near = bound <= limit
            i, j = i[near], j[near]
            low, high = np.where(ids[i] <= ids[j], i, j), np.where(ids[i] <= ids[j], j, i)
            found.append(np.stack([ids[low], ids[high], bound[near].astype(np.int64), label[low], label[high]]))
            size += len(low)
            if size >= SENT:
                yield together(found)
                found, size = [], 0
        if found:
            yield together(found)

    def together(found: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(found, axis=1)], schema.names)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in order])
            before = np.array([held[-1].column(c)[-1].as_py() for c in order]) if held else cells[:, 0]
            changes = np.flatnonzero((np.c_[before, cells[:, :-1]] != cells).any(0))
            if len(changes):  # what comes before the last cell is whole
                held.append(batch.slice(0, changes[-1]))
                yield from compared(held)
                held = []
                batch = batch.slice(changes[-1])
            held.append(batch)
        if held:
            yield from compared(held)

    dealt = rows.repartition(*order).sortWithinPartitions(*order, "n_words")
    least = [F.min(c).alias(c) for c in schema.names[2:]]
    return dealt.mapInArrow(run, schema).groupBy("low", "high").agg(*least)


def ranked(rest: DataFrame, merged: DataFrame | None) -> DataFrame:
    """The pairs whose ends are still of different classes, with their place among those of their two classes. ``merged`` has
    the classes of the labels that links among ``rest`` have joined."""
    for end in ("low_label", "high_label"):
        if merged is None:
            rest = rest.withColumn(f"{end}_class", F.col(end))
        else:
            named = merged.select(F.col("id").alias(end), F.col("component").alias(f"{end}_class"))
            rest = rest.join(named, end, "left").withColumn(f"{end}_class", F.coalesce(f"{end}_class", end))
    ends = ["low_label_class", "high_label_class"]
    place = F.row_number().over(Window.partitionBy(F.least(*ends), F.greatest(*ends)).orderBy("bound", "low", "high"))
    placed = rest.where(F.col(ends[0]) != F.col(ends[1])).withColumn("place", place)
    return placed.select("low", "high", "bound", "low_label", "high_label", "place")


def classes_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component) of the nodes that have a link."""
    pairs, crowded = candidates(nodes)
    pairs = materialize(pairs, "pairs")
    texts = held(docs, pairs.select("leader").union(pairs.select("other")).union(crowded.select("id")).toDF("id"))
    classes = components(materialize(verified(texts, pairs), "near"))
    rest = apart(members(crowded, classes)).join(unordered(pairs), ["low", "high"], "left_anti")
    links = merged = None
    tried = TRIED
    rest = materialize(ranked(rest, merged), "rest")
    texts = held(texts, rest.select("low").union(rest.select("high")).toDF("id"))
    while not (pairs := rest.where(F.col("place") <= tried)).isEmpty():
        found = verified(texts, pairs.select(F.col("low").alias("leader"), F.col("high").alias("other")))
        found = found.select(F.col("a").alias("low"), F.col("b").alias("high")).join(pairs, ["low", "high"])
        found = materialize(found.select(F.col("low_label").alias("a"), F.col("high_label").alias("b")).distinct(), "near")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            merged = components(links)
        rest, tried = materialize(ranked(rest.where(F.col("place") > tried), merged), "rest"), tried * TRIED**2
    return classes if merged is None else renamed(classes, merged)


def renamed(classes: DataFrame, merged: DataFrame) -> DataFrame:
    """The classes with those joined that ``merged`` has joined. A node without a link so far is its own label."""
    joined = merged.select(F.col("id").alias("component"), F.col("component").alias("other"))
    old = classes.join(joined, "component", "left").select("id", F.coalesce("other", "component").alias("component"))
    return old.unionByName(merged.join(classes.select("id"), "id", "left_anti").select("id", "component"))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id and class_id, the smallest id of its class."""
    rows = materialize(sketched(docs), "sketches")
    texts = rows.where("print IS NOT NULL")
    nodes = materialize(
        texts.groupBy("print")
        .agg(F.min("doc_id").alias("id"), F.first("n_words").alias("n_words"), F.first("bins").alias("bins"), F.first("keys").alias("keys"))
        .where("id IS NOT NULL"),
        "nodes",
    )
    classes = classes_of(docs, nodes)
    named = nodes.select("print", "id").join(classes, "id", "left").select(
        "print", F.coalesce("component", "id").alias("class_id")
    )
    out = texts.select("doc_id", "print").join(named, "print", "left").select("doc_id", "class_id")
    return out.unionByName(rows.where("print IS NULL").select("doc_id", F.col("doc_id").alias("class_id")))
