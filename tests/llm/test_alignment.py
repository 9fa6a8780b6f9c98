"""Tokenizer alignment against whole texts encoded by the libraries and aligned byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vecflow.llm import alignment
from vecflow.llm.token_counts import vocabulary_path

BYTES, PIECES = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
AWKWARD = [
    "", " ", "\n", "\t\t", "a", "word  two\n\n  three \n", "tab\t next\t  more", "end\x1c \x1d!\x1e\n x", "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁ mark", "x▁ y", "ß 漢字 ½ ① ﬁ é é 🙂🙂", "non break 　 wide line", "\r\n);\r\n}\r\n", "it's  'll  we've", "nul\0byte \0 x", " lead", "word" * 300,
    "漢" * 400, "a b" * 300, "\n" * 50 + "x", "x" + " " * 50 + "y",
]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def tokens(text, libraries):
    """(id, bytes) lists of both vocabularies for a whole text; nothing where either does not spell it."""
    tokenizer, pieces = libraries
    if not text:
        return [], []
    shown = {c: b for b, c in alignment.byte_characters().items()}
    a = [(i, bytes(shown[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        name = pieces.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def spans(made):
    at, out = 0, []
    for i, value in made:
        out.append((i, at, at + len(value)))
        at += len(value)
    return out


def brute(rows, libraries):
    laid, holders = [], Counter()
    for _, text in rows:
        a, b = (spans(made) for made in tokens(text, libraries))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) * len(b) < 2_000_000 else swept(a, b)
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)))
            low = high
        laid.append((a, b, links, groups))
        holders.update(set(links))
    highest = defaultdict(int)
    for (i, _), n in holders.items():
        highest[i] = max(highest[i], n)
    return Counter(
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(holders[x] == highest[x[0]] for x in links),
            sum(holders[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for (doc_id, _), (a, b, links, groups) in zip(rows, laid)
    )


def swept(a, b):
    links, j = [], 0
    for i, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return links


def result(frame):
    return Counter(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def test_awkward_texts_and_rows(spark, libraries):
    rows = [(i, t) for i, t in enumerate(AWKWARD)] + [(3, None), (None, "no id"), (4, "a"), (4, "a"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1, "x", True) for i, t in rows], "doc_id long, text string, row int, pair string, partial boolean")
    assert result(alignment.align_tokenizers(docs, BYTES, PIECES)) == brute(rows, libraries)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(docs, BYTES, PIECES).count() == 0


def test_small_table(spark, folder, libraries):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert result(alignment.align_tokenizers(spark.createDataFrame(rows, docs.schema), BYTES, PIECES)) == brute(rows, libraries)


def test_parts_of_a_long_text_add_up(spark, libraries):
    draw = random.Random(5)
    words = ["alpha", "beta\n", "\n\ngamma", "δέλτα", "x1", "漢字", "tab\tin", "  two"]
    rows = [(1, " ".join(draw.choice(words) for _ in range(3000))), (2, "short one"), (3, "y" * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert result(alignment.align_tokenizers(docs, BYTES, PIECES)) == brute(rows, libraries)
    made = alignment.aligned_documents(docs, BYTES, PIECES, limit=200).where("not partial")
    sums = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in made.collect()}
    assert sums == {r[0]: (*r[1:5], r[7]) for r in brute(rows, libraries)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "\n", "\t", "\x1c", " ", "!", "'s", "1", "é", "漢", "▁", "  ", "()", "\r"]), max_size=12))
def test_stretches_are_encoded_as_in_the_whole_text(libraries, parts):
    text = "".join(parts)
    if not text:
        return
    a, b = tokens(text, libraries)
    ((_, sums, valid, groups, *_),) = alignment.align_slice([(0, " " + text)], alignment.vocabularies(BYTES, PIECES))
    assert valid == bool(a)
    if valid:
        assert list(sums[:2]) == [len(a), len(b)]
        assert [int(i) for g in groups.split(";") for i in g.split("|")[0].split(",")] == [i for i, _ in a]
        assert [int(i) for g in groups.split(";") for i in g.split("|")[1].split(",")] == [i for i, _ in b]
