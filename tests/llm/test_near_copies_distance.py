"""Words of near copies are hashed once, and whether two texts are close is decided without the whole table."""

import time

import numpy as np

from vecflow.llm import near_copies

TEXTS = ["", "  ", "a", "A\x1cb c", "É ß 漢字 \x1c", "İ x\x0b\x0cy", "\x00 a\n\n", "x" * 3_000, " lead", "trail ", "a A b", "\ta\rb"]


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, words, share):
    """The words with some left out, put in or replaced."""
    out = []
    for word in words.tolist():
        draw = rng.random()
        out += [] if draw < share / 3 else [word, int(rng.integers(5))] if draw < 2 * share / 3 else [int(rng.integers(5))] if draw < share else [word]
    return np.array(out, np.uint64)


def test_words_of_many_texts_are_those_of_each():
    found = near_copies.hashed_texts(TEXTS)
    assert len(found) == len(TEXTS)
    assert all(np.array_equal(x, near_copies.hashed_words(t)) for x, t in zip(found, TEXTS))
    assert not len(near_copies.hashed_texts([""])[0])


def test_distances_are_those_of_the_table():
    rng = np.random.default_rng(8)
    for most in (3, 2**64 - 1):
        for _ in range(300):
            a = rng.integers(0, most, int(rng.integers(1, 90)), np.uint64)
            b = edited(rng, a, rng.random() * 0.5)
            found = table_distance(a.tolist(), b.tolist())
            assert near_copies.distance(a, b) == near_copies.distance(b, a) == found
            assert near_copies.least_distance(a, b) <= found <= near_copies.most_distance(a, b)
            limit = int(0.2 * max(len(a), len(b)) + 1e-9)
            assert near_copies.close([(a, b)]) == [found <= limit]


def test_long_texts_are_decided_alike_by_bands(monkeypatch):
    rng = np.random.default_rng(9)
    starts = [rng.integers(0, 50, 300).astype(np.uint64) for _ in range(20)]
    pairs = [(a, edited(rng, a, share)) for a in starts for share in (0.1, 0.2, 0.25)]
    found = near_copies.close(pairs)
    monkeypatch.setattr(near_copies, "COLUMN", 0)
    assert near_copies.close(pairs) == found
    assert 0 < sum(found) < len(found)


def test_close_pairs_take_a_part_of_the_time_of_bands(monkeypatch):
    rng = np.random.default_rng(10)
    starts = [rng.integers(0, 3_000, n).astype(np.uint64) for n in (500, 2_000, 8_000)]
    pairs, took = [(a, edited(rng, a, 0.12)) for a in starts], []
    for column in (getattr(near_copies, "COLUMN", 0), 0):
        monkeypatch.setattr(near_copies, "COLUMN", column, raising=False)
        start = time.process_time()
        near_copies.close(pairs)
        took.append(time.process_time() - start)
    assert took[0] < took[1] / 2, took


def test_members_of_unlike_lengths_are_apart_as_all_pairs_say(spark):
    rng = np.random.default_rng(11)
    vocabulary = rng.integers(0, 2**63, 400).astype(np.uint64)
    words = {i: vocabulary[rng.integers(0, 400, int(rng.integers(20, 200)))] for i in range(1, 40)}
    words |= {100 + i: edited(rng, words[i], 0.1) for i in range(1, 40, 2)}
    rows = [
        (1, i, i, len(w), bytearray(near_copies.binned(w)), [1, 1000 + i], 0, 0, 0) for i, w in words.items()
    ]
    schema = "key long, id long, label long, n_words long, bins binary, keys array<long>, block int, first int, second int"
    found = {(r["low"], r["high"]) for r in near_copies.apart(spark.createDataFrame(rows, schema)).collect()}
    expected = set()
    for a in words:
        for b in words:
            limit = int(0.2 * max(len(words[a]), len(words[b])) + 1e-9)
            bins = np.stack([np.frombuffer(near_copies.binned(words[x]), np.uint8) for x in (a, b)]).astype(np.int16)
            if a < b and abs(len(words[a]) - len(words[b])) <= limit and near_copies.surplus(bins, np.array([0]), np.array([1]))[0] <= limit:
                expected.add((a, b))
    assert found == expected and len(found) >= 15
