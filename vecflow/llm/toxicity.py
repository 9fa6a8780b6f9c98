"""Toxicity by a weighted grammar over clauses.

A text is cut into clauses. The lexicon writes a symbol for each word: an insult or a threat with its weight, a target,
a negation, a word of speech, a quotation mark. Three transducers read these symbols: negation writes the hits in its
scope as negated, reported speech writes what is quoted as such, and the target transducer marks a clause that addresses
somebody. Their composition, one table of arcs, gives each clause one weight for every class in ``CLASSES``; the
text has its strongest clause per class and the logarithm of the sum of its clauses.

Insults are learned: for words and word beginnings, the log odds of the labelled toxic documents that have them
against the others. Weights of the classes come from a logistic regression on the same labelled rows, so whether
negation or quotation weakens an insult is learned too. Threat, target, negation and speech words are given lists.

Both are fitted on at most about ``LABELLED`` labelled rows, all of them where there are fewer; more are chosen by a hash
of the id. These alone are written; every text is scored in one pass, and no text crosses the network.

* A null text is an empty text; it has the score of a text without any hit.
* Labels are used from rows that ``use`` selects; null labels are left out. Repeated labels count as often as they occur.
* Without any toxic or any other label, every score is the prior of the labels, or 0 if there is none.
* Whole texts are scored; columns of ``docs`` named like a result are replaced by it; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from vecflow.llm.common import Bounded, map_texts, slices, texts_of
from vecflow.llm.transducers import Transducer, compose
from vecflow.scratch import materialize

CLAUSES = re.compile(r"[.!?;:\n\r|]+")
TOKENS = re.compile(r"[^\W\d_]+n['’]t\b|[^\W\d_]+|[\"“”«»]")
THREATS = frozenset("kill hurt destroy beat burn töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset("you your yourself du dich dein ihr euch tu toi ton vous votre tú te usted vosotros they them".split())
NEGATIONS = frozenset("not never no nicht kein keine nie ne pas jamais aucun nunca ningún jamás".split())
SPEECH = frozenset("said says wrote called claimed sagte sagt schrieb nannte dit écrit appelé dijo dice escribió".split())
QUOTES = frozenset('"“”«»')
#: Words that a negation reaches.
SCOPE = 3
CLASSES = ("insult", "negated_insult", "quoted_insult", "threat", "targeted")
#: Lengths of the word beginnings in the lexicon, documents a feature needs, and its least log odds.
BEGINNINGS, LEAST_DOCS, LEAST_ODDS = (4, 5, 6, 7, 8), 5, 3.0
#: Log odds above this say no more than this, as they come from the number of labels.
MOST_ODDS = 6.0
#: A clause with a weight from here on is a sure one.
SURE_ODDS = 4.0
#: Labelled rows that are learned from, about; beyond them they are chosen by a hash of the id.
LABELLED = 50_000
#: Entries of the lexicon at most: the strongest by documents times log odds.
LEXICON = 20_000


def features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic documents, other documents) of text and toxic rows."""
    schema = StructType(
        [StructField("feature", StringType()), StructField("bad", LongType()), StructField("good", LongType())]
    )

    def run(batches):
        known = Bounded(features, 200_000)
        for batch in slices(batches):
            counts = {0: Counter(), 1: Counter()}
            for label, text in zip(batch.column("toxic").to_pylist(), texts_of(batch)):
                words = set(TOKENS.findall(text.lower()))
                counts[label].update({f for w in words for f in known[w]})
            names = list(counts[0].keys() | counts[1].keys())
            sums = [pa.array([counts[k][n] for n in names], pa.int64()) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *sums], schema.names)

    return labelled.mapInArrow(run, schema).groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Weights of the features that tell toxic documents, a bounded number of them."""
    totals = labelled.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = totals["bad"] or 0, totals["good"] or 0
    if not bad or not good:
        return {}
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    chosen = (
        feature_counts(labelled)
        .where(F.col("bad") >= LEAST_DOCS)
        .withColumn("weight", odds)
        .where(F.col("weight") >= LEAST_ODDS)
        .orderBy((F.col("bad") * F.col("weight")).desc(), "feature")
        .limit(LEXICON)
    )
    return {r["feature"]: min(r["weight"], MOST_ODDS) for r in chosen.collect()}


ALPHABET = ("", "insult", "threat", "target", "not", "said", "quote")
HITS_READ = ("insult", "threat")


def negation_transducer(scope: int = SCOPE) -> Transducer:
    """After a negation, the hits among the next ``scope`` words are written as negated. A state is the words left."""
    arcs = {}
    for left in range(scope + 1):
        for symbol in ALPHABET:
            written = f"negated_{symbol}" if left and symbol in HITS_READ else symbol
            arcs[left, symbol] = (scope if symbol == "not" else max(0, left - 1), written)
    return Transducer(0, arcs, {})


def speech_transducer() -> Transducer:
    """A word of speech opens a quotation, a mark opens or closes one; an insult inside is written as quoted."""
    arcs = {(inside, "said"): (True, "said") for inside in (False, True)}
    arcs |= {(inside, "quote"): (not inside, "quote") for inside in (False, True)}
    arcs[True, "insult"] = (True, "quoted_insult")
    return Transducer(False, arcs, {})


def target_transducer() -> Transducer:
    """A clause with a target anywhere is marked as targeted."""
    return Transducer(False, {(False, "target"): (True, "target")}, {True: frozenset({"targeted"})})


def grammar_transducer() -> Transducer:
    negated = compose(negation_transducer(), speech_transducer(), ALPHABET)
    return compose(negated, target_transducer(), ALPHABET)


class Grammar:
    """The composed transducers over the symbols that a lexicon writes."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.machine = lexicon, grammar_transducer()
        self.symbol = Bounded(self._symbol, 200_000)

    def _symbol(self, word: str) -> tuple[str, float]:
        """What the lexicon writes for a word; the empty symbol for most."""
        weight = max((self.lexicon[f] for f in features(word) if f in self.lexicon), default=0.0)
        if weight:
            return "insult", weight
        if word.endswith(("n't", "n’t")):
            return "not", 1.0
        for name, words in (("threat", THREATS), ("target", TARGETS), ("not", NEGATIONS), ("said", SPEECH), ("quote", QUOTES)):
            if word in words:
                return name, 1.0
        return "", 0.0

    def clause(self, symbols: list[tuple[str, float]]) -> np.ndarray:
        """The strongest weight of each class in one clause. A threat to nobody in the clause weighs half."""
        found = dict.fromkeys(CLASSES, 0.0)
        written, marks = self.machine.run(name for name, _ in symbols)
        for name, (_, weight) in zip(written, symbols):
            if name in found:
                found[name] = max(found[name], weight)
        if "targeted" in marks:
            found["targeted"] = max(found["insult"], found["threat"])
        else:
            found["threat"] *= 0.5
        return np.array([found[c] for c in CLASSES])

    def text(self, text: str) -> list[float]:
        """Strongest clause and logarithm of the summed clauses, for each class; whether some clause is sure."""
        symbols, most, total = self.symbol, np.zeros(len(CLASSES)), np.zeros(len(CLASSES))
        text = text.lower()
        if any(symbols[w][0] in ("insult", "threat") for w in set(TOKENS.findall(text))):
            for clause in CLAUSES.split(text):
                written = [symbols[w] for w in TOKENS.findall(clause)]
                if any(name in ("insult", "threat") for name, _ in written):
                    weights = self.clause(written)
                    most, total = np.maximum(most, weights), total + weights
        sure = most[:3].max() >= SURE_ODDS
        return [*most.tolist(), *np.log1p(total).tolist(), float(sure)]


HITS = [*(f"{kind}_{c}" for kind in ("most", "sum") for c in CLASSES), "sure_clause"]


def clause_weights(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` with the grammar's weights of each text in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)  # LEXICON entries at most
    held: list[Grammar] = []

    def weigh(batch) -> dict:
        if not held:
            held.append(Grammar(sent.value))
        return dict(zip(HITS, zip(*map(held[0].text, texts_of(batch))))) if batch.num_rows else {h: [] for h in HITS}

    keep = [c for c in docs.columns if c != "text" and c not in HITS]
    return map_texts(docs, weigh, [StructField(h, DoubleType()) for h in HITS], keep)


def fit(weights: DataFrame, label: str) -> tuple[float, list[float]]:
    """Intercept and coefficients of a ridge logistic regression by Newton steps; each step sums one small
    matrix over all labelled rows."""
    n = len(HITS)
    names = ["lit", *HITS]
    values = [F.lit(1.0)] + [F.col(h) for h in HITS]
    beta = np.zeros(n + 1)
    for _ in range(12):
        margin = sum((v * float(b) for v, b in zip(values[1:], beta[1:])), F.lit(float(beta[0])))
        p = 1 / (1 + F.exp(-margin))
        rows = weights.select(*[v.alias(f"x{i}") for i, v in enumerate(values)], p.alias("p"), F.col(label).alias("y"))
        sums = [F.sum(F.col(f"x{i}") * (F.col("y") - F.col("p"))) for i in range(len(names))]
        sums += [
            F.sum(F.col(f"x{i}") * F.col(f"x{j}") * F.col("p") * (1 - F.col("p")))
            for i in range(len(names))
            for j in range(i, len(names))
        ]
        found = [float(x or 0) for x in rows.agg(*sums).first()]
        ridge = np.diag([1e-6] + [0.05] * n)
        gradient = np.array(found[: n + 1]) - ridge @ beta
        hessian = np.zeros((n + 1, n + 1))
        hessian[np.triu_indices(n + 1)] = found[n + 1 :]
        hessian = hessian + np.triu(hessian, 1).T + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-4:
            break
    return float(beta[0]), beta[1:].tolist()


def toxicity(docs: DataFrame, labels: DataFrame, use: Column, labelled_rows: int = LABELLED) -> DataFrame:
    """doc_id, ``use``'s other columns and ``score``; ``use`` says of a document whether its labels may be learned."""
    ids = F.col("doc_id").cast("bigint").alias("doc_id")
    texts = docs.select(ids, "text")
    marked = labels.select(ids, F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)").where(use)
    sums = marked.agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("prior")).first()
    if sums["n"] > labelled_rows:  # ids and labels alone are looked at, whatever their order
        share = 1_000_000
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) < share * labelled_rows // sums["n"])
    # About ``labelled_rows`` pairs of numbers: bounded, so they go to the texts and not the texts to them.
    labelled = materialize(texts.join(F.broadcast(marked), "doc_id").select("text", "toxic"), "labelled")
    lexicon = learn_lexicon(labelled)
    if not lexicon:
        weights = clause_weights(texts, lexicon)
        return weights.select("doc_id", F.lit(float(sums["prior"] or 0)).alias("score"))
    intercept, slopes = fit(materialize(clause_weights(labelled, lexicon), "weights"), "toxic")
    margin = sum((F.col(h) * s for h, s in zip(HITS, slopes)), F.lit(intercept))
    score = 1 / (1 + F.exp(-F.least(F.greatest(margin, F.lit(-700.0)), F.lit(700.0))))
    return clause_weights(texts, lexicon).select("doc_id", score.alias("score"), *HITS)
