"""Whitening against exact fractions and numpy's own eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from vecflow.llm import whitening
from vecflow.llm.spectral import eigenvectors, polar_factor

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], schema)


def whole(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def check(rows, vectors, components=8):
    """Every returned row against exact sums and numpy."""
    x = [whole(v) for _, v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    covariance = np.array([[float(sum(Fraction(n * a[i] - sums[i]) * (n * a[j] - sums[j]) for a in x) / n**3) for j in range(d)] for i in range(d)])
    values, _ = np.linalg.eigh(covariance)
    values = values[::-1]
    count = min(components, int((values > d * np.finfo(float).eps * values[0]).sum()))
    by_row = {}
    for r in rows:
        by_row.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    assert len(rows) == n * count
    expected = sorted(((i, sum((n * c - s) ** 2 for c, s in zip(a, sums))) for (i, _), a in zip(vectors, x)), key=str)
    assert sorted(((r["vec_id"], r["deviation"]) for r in rows if r["component"] == 1), key=str) == expected
    for r in rows:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    w = np.array([[r["whitened"] for r in rows if r["component"] == k + 1] for k in range(count)])
    assert np.allclose(w @ w.T / n - np.outer(w.mean(1), w.mean(1)), np.eye(count), atol=1e-9)


def test_against_exact_sums(spark):
    draw = np.random.default_rng(3)
    vectors = [(i, [float(c) for c in draw.normal(size=12) * (1 + np.arange(12))]) for i in range(90)]
    vectors += vectors[:5] + [(None, vectors[7][1])]
    bad = [(900, None), (901, [None] + [0.0] * 11), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11), (904, [])]
    check(whitening.whitened_components(frame(spark, vectors + bad)).collect(), vectors)


def test_components_are_eigenvectors(spark):
    draw = np.random.default_rng(4)
    vectors = [(i, [float(c) for c in draw.normal(size=6) * [5, 3, 2, 1, 0.5, 0.2]]) for i in range(200)]
    model = whitening.fit(frame(spark, vectors))
    values, expected = np.linalg.eigh(np.cov(np.array([whole(v) for _, v in vectors], float).T, bias=True))
    assert np.allclose(model.variances, values[::-1], rtol=1e-10)
    assert np.allclose(np.abs(np.sum(model.vectors * expected[:, ::-1], axis=0)), 1, atol=1e-12)


def test_layout_does_not_matter(spark, folder):
    embeddings = spark.read.parquet(f"{folder}/embeddings.parquet")
    one, many = (whitening.fit(embeddings.repartition(k)) for k in (1, 16))
    assert one.sums == many.sums and np.array_equal(one.covariance, many.covariance)
    assert np.array_equal(one.vectors, many.vectors)


@pytest.mark.parametrize(
    "vectors",
    [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [math.nan, 1.0])]],
)
def test_nothing_to_whiten(spark, vectors):
    result = whitening.whitened_components(frame(spark, vectors))
    assert result.count() == 0
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_few_and_dependent_places(spark):
    vectors = [(i, [float(i % 7), float(2 * (i % 7)), float(i % 3)]) for i in range(40)]
    rows = whitening.whitened_components(frame(spark, vectors)).collect()
    assert {r["component"] for r in rows} == {1, 2}
    check(rows, vectors)


def test_large_entries_stay_exact(spark):
    vectors = [(i, [1e9 * (-1) ** i + i, float(i)]) for i in range(30)]
    rows = whitening.whitened_components(frame(spark, vectors, SCHEMA.replace("float", "double"))).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = {i: sum((30 * c - s) ** 2 for c, s in zip(a, sums)) for (i, _), a in zip(vectors, x)}
    assert {r["vec_id"]: r["deviation"] for r in rows} == {i: v if v < 2**63 else None for i, v in exact.items()}


def test_lengths_must_agree(spark):
    with pytest.raises(ValueError, match="different lengths"):
        whitening.fit(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


@pytest.mark.parametrize("kind", ["plain", "steep", "ties", "low rank", "unit", "zero", "blocks"])
@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_divide_and_conquer(kind, n):
    draw = np.random.default_rng(n)
    q, _ = np.linalg.qr(draw.normal(size=(n, n)))
    e = {
        "plain": draw.random(n) + 0.1, "steep": 10.0 ** (-np.arange(n) / 4), "ties": np.repeat(draw.random(n), 8)[:n],
        "low rank": np.where(np.arange(n) < 3, 5.0, 0.0), "unit": np.ones(n), "zero": np.zeros(n), "blocks": np.arange(n) % 2 + 1.0,
    }[kind]
    a = np.diag(e) if kind == "blocks" else (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = eigenvectors(a)
    scale = max(1e-300, np.abs(a).max())
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * scale * n)
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * scale * n
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13


def test_polar_factor_is_the_sign():
    draw = np.random.default_rng(1)
    q, _ = np.linalg.qr(draw.normal(size=(20, 20)))
    e = np.r_[np.linspace(1, 9, 8), -np.geomspace(1e-6, 3, 12)]
    assert np.allclose(polar_factor((q * e) @ q.T), (q * np.sign(e)) @ q.T, atol=1e-9)
