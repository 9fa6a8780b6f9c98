"""Exact token counts at every prefix of a text, by dynamic programming over its segments.

A piece vocabulary with priority merges encodes each run of spaces plus the word after it by itself. Within such a
segment the last token of every prefix is the one token that ends there and stands next to the last token of the
shorter prefix when the two are encoded together. The count at a prefix is then the count at the shorter prefix plus
one. Counts are kept as one signed byte for each code point (the difference to the prefix before), so truncation and
budget questions need no second encoding.

* A null text is an empty text: no bytes, no tokens, an empty array of differences.
* Repeated rows, repeated or null ids and empty tables give one row for each row.
* Whole texts are counted, however long; strings of special tokens are ordinary text, as in the library.
* Columns of ``docs`` named like an added one are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField

from vecflow.llm.common import Bounded, map_texts, texts_of

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Segments after which a worker's cache starts anew; one batch adds at most those of its own texts.
CACHED_SEGMENTS = 400_000
NEVER = float("-inf")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounter:
    """Token counts of all prefixes of a text for one piece vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.library.get_piece_size())
        special = (self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused)
        normal = [i for i in ids if not any(test(i) for test in special)]
        self.score = {self.library.id_to_piece(i): self.library.get_score(i) for i in normal}
        found: dict[str, set[int]] = {}
        for piece in self.score:
            found.setdefault(piece[-2:], set()).add(len(piece))
        self.found = {
            end: tuple(sorted(sizes | {1} if end[-1] in self.score else sizes, reverse=True)) for end, sizes in found.items()
        }
        self.sizes = Bounded(self._sizes, 400_000)
        self.fits = Bounded(self._fits, 400_000)
        self.segments: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """A short text's pieces by merging the best-scored neighbours first."""
        parts, score = list(text), self.score
        rated = [score.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while rated and (best := max(rated)) != NEVER:
            i = rated.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del rated[i]
            if i:
                rated[i - 1] = score.get(parts[i - 1] + parts[i], NEVER)
            if i < len(rated):
                rated[i] = score.get(parts[i] + parts[i + 1], NEVER)
        return parts

    def _fits(self, pair: tuple[str, str]) -> bool:
        """Whether two pieces stay apart when encoded together."""
        return self._merged(pair[0] + pair[1]) == [p for p in pair if p]

    def _sizes(self, end: str) -> tuple[int, ...]:
        """Sizes of the pieces that may end in these two characters, the longest first."""
        return self.found.get(end) or ((1,) if end[-1] in self.score else ())

    def _extend(self, segments: list[str]) -> None:
        """Put the differences of new segments into the cache.

        In sorted order neighbours share prefixes, and what is known of a shared prefix stays.
        """
        score, fits, sizes, known = self.score, self.fits, self.sizes, self.segments
        counts, last, made, before = [0], [""], bytearray(), ""
        for segment in sorted(segments):
            end = 0
            for a, b in zip(segment, before):
                if a != b:
                    break
                end += 1
            del counts[end + 1 :], last[end + 1 :], made[end:]
            for end in range(end + 1, len(segment) + 1):
                count, piece = counts[-1] + len(segment[end - 1].encode()), ""  # bytes, if no piece has the character
                for size in sizes[segment[end - 2 : end] if end > 1 else segment[0]]:
                    if size <= end:
                        start = end - size
                        candidate = segment[start:end]
                        if candidate in score and fits[last[start], candidate]:
                            count, piece = counts[start] + 1, candidate
                            break
                made.append((count - counts[-1]) & 255)
                counts.append(count)
                last.append(piece)
            known[segment] = bytes(made)
            before = segment

    def differences(self, texts: list[str]) -> list[np.ndarray]:
        """For each text one value for each code point; their sum up to a prefix is its token count."""
        found = [SEGMENT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.segments) > CACHED_SEGMENTS:
            self.segments.clear()
        self._extend(list({s for segments in found for s in segments if s not in self.segments}))
        get, made = self.segments.__getitem__, []
        for segments in found:
            values = np.frombuffer(bytearray(b"".join(map(get, segments))), np.int8)
            if len(values):
                values[1] += values[0]  # the space that the library puts before a text
            made.append(values[1:])
        return made


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def tokens_at(differences: bytes | np.ndarray, prefix: int) -> int:
    """Tokens of the first ``prefix`` code points."""
    return int(np.frombuffer(differences, np.int8)[:prefix].sum(dtype=np.int64))


def longest_within(differences: bytes | np.ndarray, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fitting = np.flatnonzero(np.cumsum(np.frombuffer(differences, np.int8), dtype=np.int64) <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def prefix_token_counts(docs: DataFrame, path: str, limit: int = 4096, keep_differences: bool = True) -> DataFrame:
    """``docs`` without text, plus n_bytes, n_tokens, fit_chars (code points of the longest prefix of at most
    ``limit`` tokens) and, if kept, ``prefix_differences`` (one signed byte for each code point)."""
    added = [
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("fit_chars", LongType()),
    ]
    if keep_differences:
        added.append(StructField("prefix_differences", BinaryType()))

    def count(batch) -> dict:
        prefixes, texts = counter(path), texts_of(batch)
        made = prefixes.differences(texts)
        totals = [int(d.sum(dtype=np.int64)) for d in made]
        fit = [len(d) if n <= limit else longest_within(d.tobytes(), limit) for d, n in zip(made, totals)]
        out = {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": totals, "fit_chars": fit}
        if keep_differences:
            out["prefix_differences"] = [d.tobytes() for d in made]
        return out

    names = {f.name for f in added}
    return map_texts(docs, count, added, [c for c in docs.columns if c != "text" and c not in names])


def _of_prefix(function: Callable[[bytes, int], int]) -> Callable[[Column, Column], Column]:
    """A function of differences and a number as one of columns; null for null differences.

    Pandas is imported here, as workers that only count have no use for it.
    """
    import pandas as pd

    def apply(differences, number):
        return pd.Series([None if d is None else function(d, n) for d, n in zip(differences, number)], dtype="Int32")

    apply.__annotations__ = {"differences": pd.Series, "number": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, IntegerType())


def tokens_of_prefix(differences: Column, prefix: Column) -> Column:
    """Column form of ``tokens_at``."""
    return _of_prefix(tokens_at)(differences, prefix)


def prefix_within(differences: Column, budget: Column) -> Column:
    """Column form of ``longest_within``."""
    return _of_prefix(longest_within)(differences, budget)
