"""Quality rules whose limits follow from the data: quantile sketches per language and source.

Every document is measured with built-in functions. Documents that pass two fixed base rules feed one mergeable
quantile sketch per metric for each pair of language and source. Sketches of a language's sources merge into one of
the language, and those into one of all documents; a pair with too few documents takes the limits of the next level.
A metric's limit lies ``SPREADS`` interquartile ranges beyond its upper quartile (for the word length also below the
lower one), and at least a small margin beyond, for metrics that hardly vary. A document is kept if no metric
passes its limit.

* A null text has no words, so it fails the base rules; so does an empty one. Null languages and sources are a group.
* Repeated rows count as often as they occur; an empty table gives no rows; whole texts are measured.
* Other columns of ``docs`` do not matter, also if they are named like a metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecflow.scratch import materialize

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Quartiles and the distance of a limit from them, in interquartile ranges.
LOWER, UPPER, SPREADS = 0.25, 0.75, 3
#: Each metric and the least distance of its limit from the quartile. Word length is in hundredths of a
#: code point, the others in ten-thousandths of the words or lines.
MARGINS = {"word_length": 150, "symbols": 500, "dup_lines": 2500, "repeats": 1500}
#: Documents that a group needs for limits of its own, and the size of a sketch.
LEAST_DOCS, SKETCH = 50, 4096


#: A key that all rows share, so that the one sketch of all documents joins like any other.
ANYTHING = "substring(lang, 1, 0)"
#: What is counted.
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_lines and the metrics of each document.

    Windows of five words are compared by 64-bit hashes. Only where some hash occurs twice are they sorted with
    their positions; each repeated position then adds the words up to the next one, five at most.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *named,
        F.filter(F.split(text, SPACES, -1), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    last = F.size("words") - (WINDOW - 1)
    hashed = split.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.array_join("words", "").alias("joined"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(last > 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn("ordered", F.when(again, F.array_sort(pairs))).drop("windows")

    def repeated(x: Column, i: Column) -> Column:
        before, after = (F.get("ordered", i + step)["h"].eqNullSafe(x["h"]) for step in (-1, 1))
        return before | after

    places = F.sort_array(F.transform(F.filter("ordered", repeated), lambda x: x["i"]))
    added = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("words")),
        lambda s, p: F.struct(p.alias("last"), (s["words"] + F.least(F.lit(WINDOW), p - s["last"])).alias("words")),
        lambda s: s["words"],
    )
    symbols = F.length("joined") - F.length(F.regexp_replace("joined", f"[{SYMBOLS}]+", ""))
    return ordered.select(
        "doc_id",
        "lang",
        "source",
        "n_lines",
        "n_words",
        F.length("joined").cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(added, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def with_rates(metrics: DataFrame) -> DataFrame:
    """Adds base_failed and the rates that have limits, as whole numbers."""

    def rate(count: str, of: str, scale: int) -> Column:
        return F.when(F.col(of) > 0, F.floor(F.col(count) * scale / F.col(of)).cast("bigint")).otherwise(0)

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return metrics.withColumns(
        {
            "base_failed": failed,
            "word_length": rate("word_chars", "n_words", 100),
            "symbols": rate("n_symbols", "n_words", 10_000),
            "dup_lines": rate("n_dup_lines", "n_lines", 10_000),
            "repeats": rate("n_repeat_words", "n_words", 10_000),
        }
    )


def sketches(rates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One sketch per metric by language and source, those merged by language, and those merged into one row."""
    made = [F.kll_sketch_agg_bigint(m, F.lit(SKETCH)).alias(m) for m in MARGINS]
    merged = [F.kll_merge_agg_bigint(m, F.lit(SKETCH)).alias(m) for m in MARGINS]
    pairs = rates.where(~F.col("base_failed")).groupBy("lang", "source").agg(*made)
    langs = pairs.groupBy("lang").agg(*merged)
    return pairs, langs, langs.groupBy(F.expr(ANYTHING).alias("one")).agg(*merged)


def limits(rates: DataFrame) -> DataFrame:
    """lang, source and for each metric the values a kept document may have at least and at most."""
    pairs, langs, everything = sketches(rates)

    def quartiles(df: DataFrame, level: str) -> DataFrame:
        first = next(iter(MARGINS))
        ends = [
            F.kll_sketch_get_quantile_bigint(m, F.lit(q)).alias(f"{m}_{level}_{name}")
            for m in MARGINS
            for name, q in (("low", LOWER), ("high", UPPER))
        ]
        keys = [c for c in df.columns if c not in MARGINS]
        return df.select(*keys, F.kll_sketch_get_n_bigint(first).alias(f"n_{level}"), *ends)

    levels = (
        quartiles(pairs, "pair")
        .join(quartiles(langs, "lang"), "lang")
        .withColumn("one", F.expr(ANYTHING))
        .join(quartiles(everything, "all"), "one")
    )

    def pick(name: str) -> Column:
        pair = F.when(F.col("n_pair") >= LEAST_DOCS, F.col(name.format("pair")))
        return pair.when(F.col("n_lang") >= LEAST_DOCS, F.col(name.format("lang"))).otherwise(
            F.col(name.format("all"))
        )

    bounds = []
    for metric, margin in MARGINS.items():
        low, high = pick(metric + "_{}_low"), pick(metric + "_{}_high")
        reach = F.greatest(SPREADS * (high - low), F.lit(margin))
        least = low - reach if metric == "word_length" else F.lit(0).cast("bigint")
        bounds += [least.alias(f"{metric}_least"), (high + reach).alias(f"{metric}_most")]
    return levels.select("lang", "source", *bounds)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the metrics, base_failed, and ``kept``. A pair all of whose documents fail the base has no limits,
    and none of its documents is kept anyway."""
    rates = with_rates(materialize(measured(docs), "quality"))
    within = F.lit(True)
    for metric in MARGINS:
        within &= F.col(metric).between(F.col(f"{metric}_least"), F.col(f"{metric}_most"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(False))
    joined = rates.join(limits(rates), ["lang", "source"], "left")
    return joined.select("doc_id", *METRICS, "base_failed", kept.alias("kept"))
