"""Links that no leader of a bucket has a part in."""

import numpy as np
import pytest

from vecflow.llm import near_copies


def nodes_in_one_bucket(spark, texts):
    """Nodes that share their first sketch and no other."""
    rows = []
    for i, text in texts.items():
        words = near_copies.hashed_words(text)
        keys = [7] + [1000 * i + j for j in range(1, near_copies.SKETCHES)]
        rows.append((i, len(words), bytearray(near_copies.binned(words)) if hasattr(near_copies, "binned") else None, keys))
    return spark.createDataFrame(rows, "id long, n_words long, bins binary, keys array<long>")


@pytest.mark.parametrize("block", [2, 2_000])
def test_members_of_a_bucket_are_linked_without_its_leaders(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block, raising=False)
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice([f"w{k}" for k in range(3_000)], 80)) for i in range(1, 12)}
    for i in (4, 7, 9):  # near copies of the next, neither the smallest of the bucket
        words = texts[i].split()
        words[5] = words[40] = "changed"
        texts[i + 1] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = near_copies.classes_of(docs, nodes_in_one_bucket(spark, texts)).collect()
    assert {(r["id"], r["component"]) for r in found} == {(4, 4), (5, 4), (7, 7), (8, 7), (9, 9), (10, 9)}


def test_the_surplus_of_words_is_never_more_than_the_distance():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (rng.integers(0, 2**63, 40).astype(np.uint64)[rng.integers(0, 40, int(rng.integers(1, 60)))] for _ in range(2))
        b = np.r_[a[: int(rng.integers(0, 30))], b]
        bins = np.stack([np.frombuffer(near_copies.binned(x), np.uint8) for x in (a, b)]).astype(np.int16)
        bound = near_copies.surplus(bins, np.array([0]), np.array([1]))[0]
        assert bound <= near_copies.least_distance(a, b)
