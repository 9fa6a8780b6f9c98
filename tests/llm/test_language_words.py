"""What counts as a letter, and long runs of letters."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecflow.llm import language
from vecflow.llm.token_counts import vocabulary_path

PIECES = vocabulary_path("piece_bpe_32k.model")


@pytest.mark.parametrize("text", ["²", "½ 12", "① ③", "٣٤", "Ⅻ", "_ __", "123", "!?", "́"])
def test_a_text_without_a_letter_is_undetermined(spark, text):
    rows = [("the cat sat on the mat", "en"), ("die Katze sitzt auf der Matte", "de")]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"), F.lit(True), PIECES)
    (row,) = language.identify(spark.createDataFrame([(text,)], "text string"), model).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def plain(word, pieces, weights):
    """Logarithm of the sum over all segmentations of one word, position by position."""
    sums = [0.0] + [-math.inf] * len(word)
    longest = max(map(len, pieces))
    for end in range(1, len(word) + 1):
        parts = []
        for size in range(1, min(longest, end) + 1):
            number = pieces.get(word[end - size : end], 0 if size == 1 else None)
            if number is not None:
                parts.append(sums[end - size] + math.log(weights[number]))
        sums[end] = float(np.logaddexp.reduce(parts))
    return sums[-1]


def test_long_runs_are_summed_whole():
    pieces, draw = language.pieces_of(PIECES), np.random.default_rng(1)
    weights = draw.random((len(pieces) + 1, 2)) * 1e-3 + 1e-9
    words = ["".join(draw.choice(list("aeiounrst漢字ก"), size=n)) for n in (1, 39, 40, 41, 80, 81, 333, 1200)] + ["ab", "a" * 500]
    scorer = language.Scorer(language.Model(["x", "y"], weights, PIECES))
    scorer.add(words)
    for word in words:
        expected = [plain(word, pieces, weights[:, i]) for i in (0, 1)]
        assert np.allclose(scorer.rows[scorer.known[word]], expected, rtol=1e-9)


def test_words_without_numerals_are_found_quickly_and_alike():
    texts = ["", "1_2", "Ⅻ½", "Wörter und x²y 12 a_b ½c Ⅻ Katze", "漢字 ก①ข ab٣cd", "İstanbul ǅ ß"]
    assert [language.words_of(t) for t in texts] == [language.WORDS.findall(t.lower()) for t in texts]
    text = "the quick brown fox jumps over lazy dogs " * 20_000
    took = []
    for find in (language.words_of, lambda t: language.WORDS.findall(t.lower())):
        start = time.process_time()
        found = find(text)
        took.append(time.process_time() - start)
        assert len(found) == 160_000
    assert took[0] < took[1] / 3  # the long list of numerals is not tried for each letter
