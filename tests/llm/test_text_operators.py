"""The text operators against brute force, on hand-written rows with the awkward cases and on small tables."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from vecflow.llm import (
    contamination,
    language,
    language_model,
    near_copies,
    packing,
    quality,
    repeats,
    token_counts,
    toxicity,
    warc,
)
from vecflow.llm.queries import ORACLES, QUERIES
from vecflow.llm.suffix_groups import suffix_order

PIECES = token_counts.vocabulary_path("piece_bpe_32k.model")
WORDS = token_counts.vocabulary_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_words int, score string, key int"
LONG = " ".join(f"word{i % 977}" for i in range(6000))
ROWS = [
    (1, None, None, None, 1, "x", 1),
    (2, "", "en", "a", None, None, None),
    (3, "The same text, the same text, the same text again.", "en", "a", 1, "x", 1),
    (3, "The same text, the same text, the same text again.", "en", "a", 1, "x", 1),
    (None, "Ein Satz ohne Nummer steht hier, und noch einer folgt.", "de", None, 1, "x", 1),
    (4, LONG, "en", "b", 1, "x", 1),
    (5, "ß 漢字 <|endoftext|> \t\n  ", None, "b", 1, "x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


# ---------------------------------------------------------------- near copies


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_decides_like_the_full_table():
    rng, pairs = random.Random(1), []
    for _ in range(200):
        a = [rng.randint(0, 30) for _ in range(rng.randint(0, 60))]
        b = [x for x in a if rng.random() > 0.07]
        for _ in range(rng.randint(0, 6)):
            b.insert(rng.randint(0, len(b)), rng.randint(0, 30))
        pairs.append((a, b))
    found = near_copies.close([(np.array(a, np.uint64), np.array(b, np.uint64)) for a, b in pairs])
    assert found == [plain_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]


def test_classes_on_awkward_rows(docs, none):
    rows = Counter(tuple(r) for r in near_copies.near_copies(docs).collect())
    assert rows == Counter([(1, 1), (2, 2), (3, 3), (3, 3), (None, None), (4, 4), (5, 5)])
    assert near_copies.near_copies(none).count() == 0


def test_classes_agree_with_all_pairs(spark, folder, documents):
    words = {d: near_copies.hashed_words(t) for d, t in documents.items()}
    ids, root = sorted(words, key=lambda d: len(words[d])), {d: d for d in words}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    pairs = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(words[a]) < 0.8 * len(words[b]):
                break
            if near_copies.least_distance(words[a], words[b]) <= 0.2 * len(words[b]):
                pairs.append((a, b))
    for (a, b), linked in zip(pairs, near_copies.close([(words[a], words[b]) for a, b in pairs])):
        if linked:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    found = {r["doc_id"]: r["class_id"] for r in QUERIES["op1_near_copies"](spark, folder).collect()}
    assert found == {d: top(d) for d in ids}


def test_planted_pairs_at_the_limit_are_found(spark):
    rng, rows, pairs = random.Random(11), [], []
    for i in range(240):
        length = (30, 300)[i % 2]
        text = [f"w{rng.randrange(10**9)}" for _ in range(length)]
        share = rng.uniform(0.15, 0.2)
        places = range(i % 5, length, 5) if i % 3 == 0 else rng.sample(range(length), int(share * length))
        other = [f"x{rng.randrange(10**9)}" if k in set(places) else w for k, w in enumerate(text)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
        pairs.append((2 * i, 2 * i + 1))
    found = {r["doc_id"]: r["class_id"] for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(c // 2 == d // 2 for d, c in found.items())
    assert sum(found[b] == a for a, b in pairs) >= 0.95 * len(pairs)


def changed(words, share, rng):
    places = set(rng.sample(range(len(words)), int(share * len(words))))
    return [f"x{rng.randrange(10**9)}" if k in places else w for k, w in enumerate(words)]


def classes_in(spark, texts):
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    made = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r["doc_id"]: r["class_id"] for r in made.collect()}


@pytest.mark.parametrize("share", (0.12, 0.15))
def test_copies_unlike_each_other_follow_an_original_with_a_larger_id(spark, share):
    rng = random.Random(3)
    original = [f"w{rng.randrange(10**9)}" for _ in range(200)]
    found = classes_in(spark, [changed(original, share, rng) for _ in range(300)] + [original])
    assert set(found.values()) == {0}


def test_a_chain_and_texts_that_only_share_a_passage(spark):
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(60)]
    chain = [[f"w{rng.randrange(10**9)}" for _ in range(140)] + passage]
    for _ in range(49):
        chain.append([*changed(chain[-1][:140], 0.1, rng), *passage])
    others = [[f"w{rng.randrange(10**9)}" for _ in range(140)] + passage for _ in range(150)]
    pairs = [text for one in others[:50] for text in (changed(one[:140], 0.15, rng) + passage,)]
    texts = others + chain + pairs
    found = classes_in(spark, texts)
    assert {found[i] for i in range(150, 200)} == {150}
    assert [found[i] for i in range(150)] == list(range(150))
    assert sum(found[200 + i] == i for i in range(50)) >= 48


# ---------------------------------------------------------------- archive


def test_archive_round_trip(spark, tmp_path):
    rows = [(2, "http://a b", "x\r\nWARC/1.1\r\n", 1), (1, None, "x\r\nWARC/1.1\r\n", 1), (3, "u", None, 1), (4, "u", "", 1), (None, "u", "é", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, header int")
    warc.write_archive(pages, f"{tmp_path}/a")
    found = {r["record_id"]: r for r in warc.reconstruct(warc.read_archive(spark, f"{tmp_path}/a")).collect()}
    assert {k: bytes(r["payload"]).decode() for k, r in found.items()} == {i: h or "" for i, _, h, _ in rows}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in found.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), None: ("response", None)
    }
    warc.write_archive(pages.where("false"), f"{tmp_path}/b")
    assert warc.read_archive(spark, f"{tmp_path}/b").count() == 0


# ---------------------------------------------------------------- quality


def test_quality_of_awkward_rows(docs, none):
    rows = {r["doc_id"]: r for r in quality.quality_report(docs).collect()}
    assert rows[1]["n_words"] == rows[2]["n_words"] == 0 and rows[1]["base_failed"] and not rows[2]["kept"]
    assert rows[4]["n_words"] == 6000 and rows[4]["base_failed"]  # windows repeat after 977 words
    assert quality.quality_report(none).count() == 0


# ---------------------------------------------------------------- packing and tokens


def test_word_tokens_agree_with_the_library():
    tokens, rng = packing.WordTokens(WORDS), random.Random(3)
    parts = ["a", "the", " ", "\n", "é", "Ñ", "漢", "<|endoftext|>", "1", ".", "'s", "'T", "!!", "\0", "İ", "Σ", "²", "_", "\x1c"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(tokens.encode(text), "<u4").tolist() == tokens.library.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts):
    library = packing.WordTokens(WORDS).library
    expected = Counter()
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[start : start + 4096], "<u4")
            expected[doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    return len(places), -(-sum(r["length"] for r in rows) // 4096)


def test_packing(spark, docs, none, folder, documents):
    check_packing(packing.pack(docs, WORDS).collect(), [(r[0], r[1]) for r in ROWS])
    assert packing.pack(none, WORDS).count() == 0
    used, least = check_packing(QUERIES["op4_best_fit_packing"](spark, folder).collect(), documents.items())
    assert used <= 1.05 * least + 1


def test_prefix_counts_agree_with_the_library(spark, docs, none, folder, documents):
    counter, rng = token_counts.PrefixCounter(PIECES), random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "é", "▁", "漢", "😀", "<s>", "23", ".", "\0", "st"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    for text, made in zip(texts, counter.differences(texts)):
        for n in range(len(text) + 1):
            assert token_counts.tokens_at(made.tobytes(), n) == len(counter.library.encode(text[:n]))
    for rows, expected in (
        (token_counts.prefix_token_counts(docs, PIECES).collect(), [(r[0], r[1]) for r in ROWS]),
        (QUERIES["op10_token_counts"](spark, folder).collect(), documents.items()),
    ):
        found = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows)
        assert found == Counter((d, len((t or "").encode()), len(counter.library.encode(t or ""))) for d, t in expected)
    assert token_counts.prefix_token_counts(none, PIECES).count() == 0


# ---------------------------------------------------------------- toxicity and language


def test_toxicity(spark, docs, none, folder):
    labels = spark.createDataFrame([(3, 1), (4, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    scores = toxicity.toxicity(docs, labels, F.lit(True)).collect()
    assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scores)
    assert toxicity.toxicity(none, labels, F.lit(True)).count() == 0
    grammar = toxicity.Grammar({"idiot": 5.0})
    plain, negated, quoted = (grammar.text(t) for t in ("what an idiot", "not an idiot", "they said idiot"))
    assert plain[0] == 5 and negated[:2] == [0, 5] and quoted[:3] == [0, 0, 5] and not any(grammar.text(""))


def test_language(spark, docs, none, folder):
    model = language.train(docs, F.lit(True), PIECES)
    rows = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "en"), (None, "de")} <= rows
    assert language.identify(docs, language.train(none, F.lit(True), PIECES)).where("lang_pred <> 'und'").count() == 0
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op9_language_id"](spark, folder).where("held_out").join(truth, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()


def test_lattice_sums_all_segmentations():
    pieces = language.pieces_of(PIECES)
    words = ["straße", "xqz", "a" * 40, "information"]
    lattice = language.Lattice(words, language.vocabulary_of(PIECES))
    weights = np.full((len(pieces) + 1, 1), 1e-3)
    for word, found in zip(words, lattice.whole(lattice.forward(weights))[:, 0]):
        sums = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                if word[start:end] in pieces or end == start + 1:
                    sums[end] += sums[start] * 1e-3
        assert math.isclose(found, sums[-1], rel_tol=1e-9)


def test_unseen_run_in_a_clear_text_with_much_training():
    pieces = language.pieces_of(PIECES)
    counts = np.full((len(pieces) + 1, 2), language.SMOOTHING)
    counts[pieces["in"]] += 1e9
    counts[pieces["information"], 1] += 1e8
    counts[pieces["form"], 0] += 1e3
    model = language.Model(["de", "en"], counts / counts.sum(0), PIECES)
    run = "\u5b57" * language.BLOCK
    names, scores = language.Scorer(model).predict([f"information {run} information", run, "information"])
    assert [names[0], names[2]] == ["en", "en"] and all(0.4 < s <= 1 for s in scores) and scores[0] > 0.99
    lattice = language.Lattice(["information", run, "straße"], language.vocabulary_of(PIECES))
    logs = lattice.logs(model.weights)
    assert np.isfinite(logs).all()
    assert np.allclose(logs[[0, 2]], np.log(lattice.whole(lattice.forward(model.weights)))[[0, 2]])
    single = np.log(model.weights[pieces.get("\u5b57", 0)])
    if "\u5b57\u5b57" not in pieces:
        assert np.allclose(logs[1], language.BLOCK * single)


# ---------------------------------------------------------------- contamination


def test_contamination(spark, docs, none):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short one"), (None, "")], "item_id long, text string")
    texts = spark.createDataFrame(
        [(1, f"before {item.upper()}, after"), (2, item.replace("twelve", "x")), (3, "a short one here"), (4, None), (5, "ten two")],
        "doc_id long, text string",
    )
    found = {(r["doc_id"], r["item_id"], r["start_word"]) for r in contamination.contaminated(texts, bench).collect()}
    assert (1, 7, 1) in found and (3, 9, 1) in found and {d for d, _, _ in found} <= {1, 2, 3}
    assert [r["doc_id"] for r in contamination.clean(texts, bench).orderBy("doc_id").collect()][-2:] == [4, 5]
    assert contamination.contaminated(none, bench).count() == 0
    assert contamination.clean(docs, bench.where("false")).count() == len(ROWS)


# ---------------------------------------------------------------- repeats


def test_suffix_order():
    rng = random.Random(4)
    for _ in range(500):
        text = bytes(rng.choice(b"abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40)))
        assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def plain_repeats(rows):
    seen, out = Counter(), Counter()
    for _, text in rows:
        raw = (text or "").encode()
        seen.update(raw[i : i + 200] for i in range(len(raw) - 199))
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out[doc_id, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("many", [4000, 5])
def test_repeats_agree_with_counting(spark, none, monkeypatch, many):
    monkeypatch.setattr(repeats, "MANY", many)
    rng = random.Random(5)
    made = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    p, q = made(300), made(400)
    rows = [(1, made(250) + p), (2, p + made(100)), (3, p[:150] + made(10) + p[150:]), (4, "a" * 1000), (5, None), (6, "")]
    rows += [(7, "x" * 200), (7, "x" * 200), (None, p + "é" * 150), (8, made(90) * 5)]
    rows += [(100 + i, made(rng.randint(0, 90)) + q[rng.randint(0, 150) : rng.randint(200, 400)] + made(9)) for i in range(40)]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=False)
    assert Counter(tuple(r) for r in found.collect()) == plain_repeats(rows)
    assert repeats.remove_repeats(none).count() == 0


# ---------------------------------------------------------------- scoring and pipeline


def test_base_score(spark, docs, none):
    rows = language_model.text_scores(docs, F.lit(True)).collect()
    counts = Counter()
    for r in ROWS:
        counts.update([*language_model.tokens_of(r[1] or ""), language_model.END])
    total = sum(counts.values()) + len(counts) + 1
    expected = sorted(
        sum(math.log10((counts[t] + 1) / total) for t in [*language_model.tokens_of(r[1] or ""), language_model.END]) for r in ROWS
    )
    assert np.allclose(sorted(r["base_score"] for r in rows), expected)
    assert all(r["score"] < 0 and r["n_known"] == r["n_tokens"] for r in rows)


@pytest.mark.parametrize("chunk", [40, 4_000])
def test_whole_token_counts_come_from_all_chunks(spark, monkeypatch, chunk):
    rng = random.Random(3)
    train = Counter("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))).encode() for _ in range(400))
    others = {bytes(x) for a in range(33, 127) for x in ([a], *([a, b] for b in range(33, 127)))} - set(train)
    rows = [(t, n) for t, n in train.items()] + [(t, 0) for t in sorted(others)[::4]]
    counts = spark.createDataFrame(rows, "token binary, n long").repartition(3)
    monkeypatch.setattr(language_model, "CHUNK", chunk)
    tables = np.zeros((2, language_model.ORDERS << language_model.TABLE_BITS))
    found = {}
    for partitions in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            dealt = language_model.chunked(counts)
            scored = language_model.token_scores(dealt, language_model.Mixer(tables)).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert sorted((bytes(r["token"]), r["n"]) for r in scored) == sorted(rows)
        found[partitions] = {bytes(r["token"]): r["score"] for r in scored}
        assert sum(10 ** r["score"] for r in scored) <= 1 + 1e-9
    tokens, n = sorted(t for t, _ in rows), dict(rows)
    none = language_model.Shared(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    with np.errstate(over="ignore"):
        alone = language_model.Mixer(tables).log10(tokens, np.array([n[t] for t in tokens], float), none)
    for partitions in (1, 5):
        assert np.allclose([found[partitions][t] for t in tokens], alone)


def test_near_dedup_keeps_one_row_of_each_class(spark, folder):
    import corpus_pipeline

    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(240)) for _ in range(9)]
    texts = [" ".join(t[i : i + 6] for i in range(0, 240, 6)) for t in texts]
    near = " ".join(["changed", *texts[3].split(" ")[1:]])
    rows = [(1, texts[0])] * 3 + [(None, texts[1])] * 3 + [(None, texts[2]), (7, texts[2]), (5, texts[2])]
    rows += [(2, texts[3]), (9, near), (9, texts[4]), (None, near), (3, texts[5]), (3, texts[6])]
    rows += [(None, texts[7]), (None, texts[8]), (4, None), (4, None), (None, ""), (None, "")]
    expected = Counter([(1, texts[0]), (None, texts[1]), (5, texts[2]), (2, texts[3]), (9, texts[4])])
    expected += Counter([(3, texts[5]), (3, texts[6]), (None, texts[7]), (None, texts[8])])
    expected += Counter([(4, None), (4, None), (None, ""), (None, "")])
    made = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for order in (made, made.orderBy(F.desc("doc_id"))):
        kept = corpus_pipeline.one_of_each(spark, order.repartition(3), folder)
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == expected
    left = corpus_pipeline.without_repeats(spark, kept, folder).where("text <> ''").collect()
    assert Counter((r["doc_id"], r["text"]) for r in left) == Counter({x: n for x, n in expected.items() if x[1]})


def test_pipeline(spark, folder, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r["doc_id"] for r in rows} <= set(documents)
