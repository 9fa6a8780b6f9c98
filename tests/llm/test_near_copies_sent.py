"""What near copies send: later rounds only their own links, and only texts that are compared."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecflow.llm import near_copies
from vecflow.llm.components import components


def in_one_bucket(spark, more=(), shared=1):
    """Documents, ``more`` of which are in no bucket, and nodes that share their first ``shared`` sketches and no other. 2 and 3 are near
    copies of 1; 4 and 5, 7 and 8, 9 and 10 of each other."""
    rng = np.random.default_rng(5)
    texts = {i: " ".join(rng.choice([f"w{k}" for k in range(3_000)], 80)) for i in [*range(1, 12), *more]}
    for i, j in ((1, 2), (1, 3), (4, 5), (7, 8), (9, 10)):
        words = texts[i].split()
        words[5 + j] = words[40] = f"changed{j}"
        texts[j] = " ".join(words)
    rows = []
    for i in range(1, 12):
        words = near_copies.hashed_words(texts[i])
        rows.append((i, len(words), bytearray(near_copies.binned(words)), [7 + j if j < shared else 1000 * i + j for j in range(near_copies.SKETCHES)]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return docs, spark.createDataFrame(rows, "id long, n_words long, bins binary, keys array<long>")


CLASSES = {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 7), (8, 7), (9, 9), (10, 9)}


def classes(docs, nodes):
    return {(r["id"], r["component"]) for r in near_copies.classes_of(docs, nodes).collect()}


def test_later_rounds_join_classes_by_their_own_links(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(near_copies, "components", lambda links: calls.append(links.count()) or components(links))
    assert classes(*in_one_bucket(spark)) == CLASSES
    assert calls == [2, 3]


def test_texts_that_are_not_compared_stay_where_they_are(spark, monkeypatch):
    sent, verified = [], near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda docs, pairs: sent.append(docs.count()) or verified(docs, pairs))
    assert classes(*in_one_bucket(spark, range(100, 600))) == CLASSES
    assert sent and max(sent) < 100


@pytest.mark.parametrize("sent", [1, 7])
def test_pairs_are_handed_on_in_parts(spark, monkeypatch, sent):
    monkeypatch.setattr(near_copies, "SENT", sent)
    assert classes(*in_one_bucket(spark)) == CLASSES


def test_a_pair_that_shares_several_sketches_is_found(spark):
    docs, nodes = in_one_bucket(spark, shared=5)
    crowded = near_copies.candidates(nodes)[1]
    linked = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, component long")
    rows = near_copies.members(crowded, linked)
    assert rows.count() == 5 * 11
    assert {(r["low"], r["high"]) for r in near_copies.apart(rows).collect()} == {(4, 5), (7, 8), (9, 10)}
    assert classes(docs, nodes) == CLASSES


def test_all_wanted_texts_are_held_also_when_the_marks_are_full(spark, monkeypatch):
    docs = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    wanted = spark.range(0, 2_000, 3)
    for most in (1 << 27, 1 << 6):
        monkeypatch.setattr(near_copies, "MARKS", most)
        found = {r["doc_id"] for r in near_copies.held(docs, wanted).collect()}
        assert found >= set(range(0, 2_000, 3))


def test_classes_joined_by_links_between_classes(spark):
    old = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (6, 6), (7, 6)], "id long, component long")
    merged = spark.createDataFrame([(1, 1), (3, 1), (5, 1)], "id long, component long")  # 5 had no link
    found = {(r["id"], r["component"]) for r in near_copies.renamed(old, merged).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6), (7, 6)}


def test_components_of_repeated_and_reversed_links(spark):
    rng = random.Random(6)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)]
    links += [(b, a) for a, b in links[:30]] + links[:20] + [(200 + i, 201 + i) for i in range(30)]
    root = {i: i for link in links for i in link}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    found = {(r["id"], r["component"]) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(i, top(i)) for a, b in links if a != b for i in (a, b)}
