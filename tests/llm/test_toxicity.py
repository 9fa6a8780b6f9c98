"""The toxicity grammar: transducers, their composition, clauses against a plain reading, and held-out labels."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecflow.llm import toxicity
from vecflow.llm.queries import QUERIES
from vecflow.llm.transducers import Transducer, compose

PARTS = [toxicity.negation_transducer(2), toxicity.speech_transducer(), toxicity.target_transducer()]


@pytest.mark.parametrize("first,second", [(0, 1), (1, 0), (0, 2), (2, 1)])
def test_a_composition_writes_what_its_parts_write_in_turn(first, second):
    a, b = PARTS[first], PARTS[second]
    both = compose(a, b, toxicity.ALPHABET)
    for n in range(5):
        for symbols in itertools.product(toxicity.ALPHABET, repeat=n):
            between, marks_a = a.run(symbols)
            out, marks_b = b.run(between)
            assert both.run(symbols) == (out, marks_a | marks_b)


def test_composition_is_associative_and_small():
    a, b, c = PARTS
    left = compose(compose(a, b, toxicity.ALPHABET), c, toxicity.ALPHABET)
    right = compose(a, compose(b, c, toxicity.ALPHABET), toxicity.ALPHABET)
    draw = random.Random(1)
    for _ in range(500):
        symbols = draw.choices(toxicity.ALPHABET, k=12)
        assert left.run(symbols) == right.run(symbols)
    assert len(left.marks) == 3 * 2 * 2


def test_a_pair_without_an_arc_is_copied():
    plain = Transducer(0, {(0, "a"): (1, "b")}, {1: frozenset({"seen"})})
    assert plain.run("xax") == (["x", "b", "x"], frozenset({"seen"})) and plain.run("xx") == (["x", "x"], frozenset())


def read(symbols):
    """The classes of a clause by looking around each hit."""
    found = dict.fromkeys(toxicity.CLASSES, 0.0)
    names = [n for n, _ in symbols]
    for i, (name, weight) in enumerate(symbols):
        negated = "not" in names[max(0, i - toxicity.SCOPE) : i]
        inside = False
        for earlier in names[:i]:
            inside = True if earlier == "said" else not inside if earlier == "quote" else inside
        if name == "threat" and not negated:
            found["threat"] = max(found["threat"], weight)
        if name == "insult":
            kind = "negated_insult" if negated else "quoted_insult" if inside else "insult"
            found[kind] = max(found[kind], weight)
    if "target" in names:
        found["targeted"] = max(found["insult"], found["threat"])
    else:
        found["threat"] /= 2
    return [found[c] for c in toxicity.CLASSES]


def test_clauses_against_a_plain_reading():
    grammar, draw = toxicity.Grammar({}), random.Random(3)
    for _ in range(3000):
        names = draw.choices(toxicity.ALPHABET, k=draw.randrange(9))
        symbols = [(n, draw.choice([1.0, 2.5, 5.0]) if n == "insult" else 1.0) for n in names]
        assert list(grammar.clause(symbols)) == read(symbols)


def test_negations_reach_their_scope_only_and_may_be_contracted():
    grammar = toxicity.Grammar({"idiot": 5.0})

    def classes(text):
        return dict(zip(toxicity.CLASSES, grammar.text(text)))

    assert classes("you isn't an idiot")["negated_insult"] == 5 and classes("you isn’t an idiot")["insult"] == 0
    assert classes("kill you but do not kill them")["threat"] == 1
    assert classes("not one two three idiot")["insult"] == 5 and classes("not one two idiot")["negated_insult"] == 5


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op5_toxicity"](spark, folder).where("held_out")
    rows = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    toxic = np.array([r["toxic"] for r in rows])
    marked = np.array([r["predicted"] for r in rows])
    assert marked[toxic == 1].mean() >= 0.8 and marked[toxic == 0].mean() <= 0.03


def test_a_bounded_number_of_labels_is_learned_from(spark, folder):
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.toxicity(documents, labels, F.lit(True), labelled_rows=40)
    assert scored.count() == documents.count() and scored.where("score NOT BETWEEN 0 AND 1").count() == 0
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_repeated_rows_null_ids_and_labels(spark):
    rows = [(1, "you idiot"), (1, "you idiot"), (None, "fine words"), (2, None), (3, "")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, labels, F.lit(True)).count() == 5
    assert toxicity.toxicity(docs, labels.limit(0), F.lit(True)).agg(F.max("score")).first()[0] == 0
