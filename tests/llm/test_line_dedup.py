"""Line removal against plain Python."""

import random
from collections import Counter, defaultdict

from vecflow.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lines string, r1 int, at string"


def key(line):
    return line.strip(WHITE).translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))


def brute(rows, least_chars=40, least_docs=5):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(doc_id)
    frequent = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= least_docs}
    out = Counter()
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in frequent or doc_id == frequent[key(x)]]
        out[doc_id, "\n".join(left), len(lines), len(lines) - len(left)] += 1
    return out


def result(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], SCHEMA)
    made = line_dedup.drop_lines(docs, **options)
    assert made.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    return Counter(tuple(r) for r in made.collect())


def test_awkward_rows(spark):
    long = "This line is long enough to be dropped, surely"
    exact = "x" * 40
    rows = [(i, f"own {i}\n  {long}\t\r\n{long.upper()}\nend") for i in range(1, 8)]
    rows += [(i, exact + "\n" + exact[:-1]) for i in range(1, 6)]
    rows += [(20 + i, "\x1c" + long + " ") for i in range(5)]  # other white space belongs to the line
    rows += [(30, None), (31, ""), (None, f"no id\n{long}"), (None, f"no id\n{long}"), (30, long), (32, "\n\n"), (7, rows[6][1])]
    rows += [(40, "\n".join([long] * 3)), (40, "\n".join([long] * 2)), (41, "ÄÖÜ" * 15), (42, "äöü" * 15), (43, "é" * 39)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, least_chars=3, least_docs=2) == brute(rows, 3, 2)


def test_rows_without_id_are_one_document(spark):
    line = "y" * 50
    rows = [(None, line)] * 10 + [(i, line) for i in range(3)]
    assert result(spark, rows) == brute(rows) and sum(n for (*_, dropped), n in brute(rows).items() if dropped) == 0
    rows += [(3, line)]
    assert result(spark, rows) == brute(rows)


def test_all_lines_dropped_and_a_text_of_many_lines(spark):
    line = "a line that all of the documents have in common"
    rows = [(i, line) for i in range(6)] + [(9, "\n".join(f"{line} {i % 50}" for i in range(20_000)))]
    rows += [(i, f"{line} 7") for i in range(10, 16)]
    assert result(spark, rows) == brute(rows)


def test_random_texts(spark):
    draw = random.Random(2)
    lines = ["abc", "ABC", " abc", "abcd", "", "\r", "zz zz", "Zz zz"]
    rows = [(draw.choice([None, *range(12)]), "\n".join(draw.choices(lines, k=draw.randrange(6)))) for _ in range(80)]
    for chars, docs in ((0, 5), (3, 4), (4, 1)):
        assert result(spark, rows, least_chars=chars, least_docs=docs) == brute(rows, chars, docs)


def test_empty_table(spark):
    assert result(spark, []) == Counter()
