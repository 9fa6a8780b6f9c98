"""What the stages of the pipeline leave on disk and what they send."""

from collections import Counter

import pyarrow.parquet as pq
import pytest
from test_text_operators import plain_repeats

import corpus_pipeline
from vecflow import scratch
from vecflow.llm import near_copies, repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def root(tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    return tmp_path


def words(i, n=80):
    return " ".join(f"w{(i * 7919 + j * j * 31) % 100_003}" for j in range(n))


def codecs(root, name):
    files = [f for f in root.glob(f"{name}-*/*.parquet") if pq.read_metadata(f).num_rows]
    assert files
    return {pq.read_metadata(f).row_group(0).column(0).compression for f in files}


def test_whole_texts_are_kept_small(spark, folder, root):
    rows = [(i, words(i // 2) + f" end{i}", "en", "s", 1) for i in range(20)]
    kept = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(0, 20, 2))
    assert codecs(root, "rows") == codecs(root, "texts") == {"ZSTD"}


@pytest.mark.parametrize("marks", [near_copies.MARKS, 64])
def test_stretches_that_meet_no_other_stay_where_they_are(spark, root, monkeypatch, marks):
    monkeypatch.setattr(near_copies, "MARKS", marks)
    sent = []
    monkeypatch.setattr(repeats, "among", lambda *a: sent.append((a[0].count(), near_copies.among(*a))) or sent[-1][1])
    rows = [(i, words(i)) for i in range(60)] + [(None, words(3)), (61, words(4, 50) + "x"), (62, None)]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=False)
    assert Counter(tuple(r) for r in found.collect()) == plain_repeats(rows)
    ((every, likely),) = sent
    assert every > 60
    if marks > 64:
        assert likely.count() < every / 4
