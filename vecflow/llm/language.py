"""Language identification by unigram pieces, summed over every segmentation of a word.

Each language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over
all ways to cut it into pieces, by a forward pass; the probability of a text is the product over its words. The piece
probabilities come from one expectation step: distinct training words are counted once per language, a forward and a
backward pass with the same start weights for all languages give each piece its expected count in a word, and the
counts of all words are added up. What reaches the driver is one row per piece and language at most.

* Words are runs of letters (numerals of any kind are none), in lower case. Words of any length are scored whole; for the
  expected counts of training, longer ones than ``BLOCK`` characters are cut into blocks of that size.
* A null text, and one without letters, is ``und`` with score 0. Rows without a language are not learned from.
* Repeated rows count as often as they occur, also in training; ties go to the first language by name.
* Empty tables give no rows; without any training row every prediction is ``und``.
* The score is the posterior of the predicted language against the other learned ones under equal priors.
* Columns of ``docs`` named like a result are replaced by it.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vecflow.llm.common import map_texts, slices, texts_of
from vecflow.llm.token_counts import SPACE

#: Characters that count as word characters of a pattern but are neither letters nor decimal digits, such as fractions.
NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
WORDS = re.compile(rf"[^\W\d_{NUMERALS}]+")
#: The same with numerals: a test of each character against their long list takes ten times as long.
RUNS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
BLOCK = 40
#: Added to each expected count; the start weight of a piece by its number of characters.
SMOOTHING, START = 0.1, 1e-4
#: Sums below this are made again from logarithms: far above what a float loses, which is about 1e-308.
SMALL = 1e-200
CACHED_WORDS = 200_000
#: Words of a batch times the characters of the longest.
LATTICE_CELLS = 800_000
FILTER_BITS, FACTOR = 20, 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def pieces_of(path: str) -> dict[str, int]:
    """Numbers of the vocabulary's pieces without the mark of a word's start, in lower case; 0 is for
    characters that no piece is made of."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = {library.id_to_piece(i).replace(SPACE, "").lower() for i in range(library.get_piece_size())}
    return {p: i for i, p in enumerate(sorted(n for n in names if WORDS.fullmatch(n)), 1)}


def words_of(text: str) -> list[str]:
    """All matches of ``WORDS`` in the text in lower case. Only what is no letter throughout is matched against the numerals."""
    runs = RUNS.findall(text.lower())
    return runs if "".join(runs).isalpha() else [word for run in runs for word in ([run] if run.isalpha() else WORDS.findall(run))]


def blocks(word: str) -> list[str]:
    return [word[i : i + BLOCK] for i in range(0, len(word), BLOCK)]


class Vocabulary:
    """Numbers of pieces by a hash of their characters."""

    def __init__(self, pieces: dict[str, int]):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        hashes = np.array([self.of(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array(list(pieces.values()), np.int64)[order]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[hashes >> np.uint64(64 - FILTER_BITS)] = True

    @staticmethod
    def of(piece: str) -> int:
        value = 0
        for c in piece:
            value = (value + ord(c) + 1) * FACTOR % 2**64
        return value

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and their numbers."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[place] == hashes[at]
        return at[same], self.numbers[place[same]]


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(pieces_of(path))


class Lattice:
    """All pieces inside a batch of words, ordered by their end. Memory grows with the words times the longest."""

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.block = int(self.lengths.max(initial=0))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(len(words)), self.lengths)
        start = np.arange(len(chars)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        left = self.lengths[row] - start
        alive, hashes, found = np.arange(len(chars)), np.zeros(len(chars), np.uint64), []
        for size in range(1, vocabulary.longest + 1):
            keep = left[alive] >= size
            alive, hashes = alive[keep], hashes[keep]
            if not len(alive):
                break
            hashes = (hashes + chars[alive + size - 1] + np.uint64(1)) * np.uint64(FACTOR)
            at, numbers = vocabulary.find(hashes)
            if size == 1:
                every = np.zeros(len(alive), np.int64)
                every[at] = numbers
                at, numbers = np.arange(len(alive)), every
            i = alive[at]
            found.append(np.stack([start[i] + size, row[i], start[i], numbers]))
        edges = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
        edges = edges[:, np.argsort(edges[0] * len(words) + edges[1], kind="stable")]
        cuts = np.searchsorted(edges[0], np.arange(self.block + 2))
        self.by_end = [edges[1:, cuts[e] : cuts[e + 1]] for e in range(self.block + 1)]

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of each prefix: (words, longest + 1, languages)."""
        sums = np.zeros((len(self.lengths), self.block + 1, weights.shape[1]))
        sums[:, 0] = 1
        for end, (rows, starts, numbers) in enumerate(self.by_end):
            if len(rows):
                found = sums[rows, starts] * weights[numbers]
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                sums[rows[first], end] = np.add.reduceat(found, first, axis=0)
        return sums

    def whole(self, sums: np.ndarray) -> np.ndarray:
        return sums[np.arange(len(self.lengths)), self.lengths]

    def logs(self, weights: np.ndarray) -> np.ndarray:
        """Logarithms of ``whole``; words that a plain sum could lose are summed as logarithms."""
        if self.block > BLOCK:  # a plain sum could lose any of them
            whole = np.zeros((len(self.lengths), weights.shape[1]))
        else:
            whole = self.whole(self.forward(weights))
        small = (whole < SMALL).any(1)
        logs = np.log(np.where(small[:, None], 1, whole))
        if small.any():
            weights, place = np.log(weights), np.cumsum(small) - 1
            sums = np.full((int(small.sum()), self.block + 1, weights.shape[1]), -np.inf)
            sums[:, 0] = 0
            for end, edges in enumerate(self.by_end):
                rows, starts, numbers = edges[:, small[edges[0]]]
                if len(rows):
                    found = sums[place[rows], starts] + weights[numbers]
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    sums[place[rows[first]], end] = np.logaddexp.reduceat(found, first, axis=0)
            logs[small] = sums[np.arange(len(sums)), self.lengths[small]]
        return logs

    def expected(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, piece and the expected number of that piece in the word, for one column of weights."""
        forward = self.forward(weights)[:, :, 0]
        backward = np.zeros_like(forward)
        backward[np.arange(len(self.lengths)), self.lengths] = 1
        found = []
        for end in range(self.block, 0, -1):
            rows, starts, numbers = self.by_end[end]
            if len(rows):
                weight = weights[numbers, 0] * backward[rows, end]
                np.add.at(backward, (rows, starts), weight)
                found.append((rows, numbers, weight * forward[rows, starts]))
        rows, numbers, amounts = (np.concatenate(x) for x in zip(*found))
        return rows, numbers, amounts / backward[rows, 0]


def start_weights(pieces: dict[str, int]) -> np.ndarray:
    """The same for every piece, so that fewer pieces are likelier; single characters stay possible."""
    return np.full((len(pieces) + 1, 1), START)


def piece_counts(words: DataFrame, languages: list[str], path: str) -> DataFrame:
    """(piece, language, expected count) from (word, language, count) rows."""
    schema = StructType(
        [StructField("piece", IntegerType()), StructField("language", IntegerType()), StructField("n", DoubleType())]
    )

    def run(batches):
        pieces, vocabulary = pieces_of(path), vocabulary_of(path)
        weights = start_weights(pieces)
        total = np.zeros((len(languages), len(pieces) + 1))
        number = {x: i for i, x in enumerate(languages)}
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                cut = [blocks(w) for w in part.column("word").to_pylist()]
                owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
                rows, found, amounts = Lattice([b for c in cut for b in c], vocabulary).expected(weights)
                language = np.array([number[x] for x in part.column("lang").to_pylist()])
                counts = part.column("n").to_numpy()
                np.add.at(total, (language[owner[rows]], found), amounts * counts[owner[rows]])
        language, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)), pa.array(total[language, piece])],
            schema.names,
        )

    return words.mapInArrow(run, schema).groupBy("piece", "language").agg(F.sum("n").alias("n"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(word, lang, n) of all words, combined within a task's batches before they are dealt out."""
    schema = StructType([StructField("word", StringType()), StructField("lang", StringType()), StructField("n", LongType())])

    def run(batches):
        for batch in slices(batches, text):
            by_language: dict[str, Counter] = {}
            for language, words in zip(batch.column(lang).to_pylist(), texts_of(batch, text)):
                by_language.setdefault(language, Counter()).update(words_of(words))
            for language, counts in by_language.items():
                columns = [pa.array(counts.keys(), pa.string()), pa.array([language] * len(counts), pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts.values(), pa.int64())], schema.names)

    return docs.select(text, lang).mapInArrow(run, schema).groupBy("word", "lang").agg(F.sum("n").alias("n"))


class Model:
    """Languages and the logarithm-free piece probabilities of each, one column per language."""

    def __init__(self, languages: list[str], weights: np.ndarray, path: str):
        self.languages, self.weights, self.path = languages, weights, path


def train(docs: DataFrame, use: Column, path: str) -> Model:
    """Learn from the rows of ``docs`` for which ``use`` holds and that have a language."""
    rows = docs.where(use & F.col("lang").isNotNull()).select("text", "lang")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    pieces = pieces_of(path)
    counts = np.full((len(pieces) + 1, len(languages)), SMOOTHING)
    if languages:
        for r in piece_counts(word_counts(rows), languages, path).toArrow().to_batches():
            counts[r.column("piece").to_numpy(), r.column("language").to_numpy()] += r.column("n").to_numpy()
    return Model(languages, counts / counts.sum(0), path)


class Scorer:
    """Logarithms of word probabilities by language; one matrix row for each distinct word."""

    def __init__(self, model: Model):
        self.model, self.known, self.rows = model, {}, np.zeros((0, len(model.languages)))

    def add(self, words: list[str]) -> None:
        vocabulary, made = vocabulary_of(self.model.path), []
        words = sorted(words, key=len)
        start = 0
        while start < len(words):
            end = start + 1
            while end < len(words) and (end - start) * max(BLOCK, len(words[end])) < LATTICE_CELLS:
                if len(words[start]) <= BLOCK < len(words[end]):
                    break  # long words are summed in another way
                end += 1
            made.append(Lattice(words[start:end], vocabulary).logs(self.model.weights))
            start = end
        if words:
            self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
            self.rows = np.concatenate([self.rows, *made])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        found = [words_of(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.rows = {}, self.rows[:0]
        self.add(list({w for words in found for w in words if w not in self.known}))
        names, scores = [], []
        for words in found:
            if not words or not self.model.languages:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = self.rows[[self.known[w] for w in words]].sum(0)
            best = int(total.argmax())
            names.append(self.model.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one number for each piece and language
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    held: list[Scorer] = []

    def predict(batch) -> dict:
        if not held:  # once for a task
            held.append(Scorer(sent.value))
        names, scores = held[0].predict(texts_of(batch))
        return {"lang_pred": names, "score": scores}

    return map_texts(docs, predict, added, [c for c in docs.columns if c not in ("lang_pred", "score")])
