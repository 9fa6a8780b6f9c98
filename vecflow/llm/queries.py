"""Registered queries of the text operators, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.llm import (
    alignment,
    contamination,
    language,
    language_model,
    line_dedup,
    near_copies,
    packing,
    quality,
    repeats,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from vecflow.llm.common import remainder
from vecflow.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies.near_copies(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op2_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), path)
    archive = warc.read_archive(spark, path, keep_payload=False)
    return warc.reconstruct(archive).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_DIGIT = "(strpos('0123456789abcdef', substr(h, {0}, 1)) - 1)"
_FIVE_BITS = (
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((16 * "
    + _DIGIT.format("i * 5 // 4 + 1")
    + " + "
    + _DIGIT.format("i * 5 // 4 + 2")
    + ") >> (3 - i * 5 % 4)) & 31)::INTEGER + 1, 1)"
)
ORACLES["op2_warc_archive"] = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
  FROM pages)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: {_FIVE_BITS}), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p"""


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"))


def _quality_sql() -> str:
    levels = {"pair": "PARTITION BY lang, source", "lang": "PARTITION BY lang", "all": ""}
    ends, picked, bounds = [], [], []
    for metric, margin in quality.MARGINS.items():
        for name, q in (("low", quality.LOWER), ("high", quality.UPPER)):
            for level, over in levels.items():
                ends.append(f"quantile_disc({metric}, {q}) FILTER (NOT base_failed) OVER ({over}) AS {metric}_{level}_{name}")
            picked.append(
                f"CASE WHEN n_pair >= {quality.LEAST_DOCS} THEN {metric}_pair_{name} WHEN n_lang >= {quality.LEAST_DOCS} "
                f"THEN {metric}_lang_{name} ELSE {metric}_all_{name} END AS {metric}_{name}"
            )
        reach = f"greatest({quality.SPREADS} * ({metric}_high - {metric}_low), {margin})"
        least = f"{metric}_low - {reach}" if metric == "word_length" else "0"
        bounds.append(f"{metric} BETWEEN {least} AND {metric}_high + {reach}")
    counted = [f"count(*) FILTER (NOT base_failed) OVER ({levels[v]}) AS n_{v}" for v in ("pair", "lang")]
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS five
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(5) AS r(j) GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^{quality.SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length,
         CASE WHEN n_words > 0 THEN n_symbols * 10000 // n_words ELSE 0 END AS symbols,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 10000 // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN n_repeat_words * 10000 // n_words ELSE 0 END AS repeats
  FROM m),
e AS (SELECT *, {', '.join(counted)}, {', '.join(ends)} FROM r),
b AS (SELECT *, {', '.join(picked)} FROM e)
SELECT doc_id, {', '.join(quality.METRICS)}, base_failed,
       NOT base_failed AND {' AND '.join(bounds)} AS kept
FROM b"""


ORACLES["op3_quality_rules"] = _quality_sql()


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), token_counts.vocabulary_path("word_bpe_49k.json"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    rest = remainder(F.col("doc_id"), 3)
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.toxicity(documents, labels, rest != 1).select(
        "doc_id", (rest == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return contamination.contaminated(documents, table(spark, folder, "benchmark"))


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return repeats.remove_repeats(documents, keep_text=False)


@query
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scores = language_model.text_scores(documents, remainder(F.col("doc_id"), 7) != 2)
    return scores.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = language.train(documents, ~held_out, token_counts.vocabulary_path("piece_bpe_32k.model"))
    return language.identify(documents.drop("lang"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = token_counts.vocabulary_path("piece_bpe_32k.model")
    counts = token_counts.prefix_token_counts(table(spark, folder, "documents"), path, keep_differences=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "fit_chars")


@query
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_KEY = f"translate(trim(line, concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))), '{line_dedup.UPPER}', '{line_dedup.LOWER}')"
ORACLES["op11_line_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
k AS (SELECT *, {_KEY} AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM k WHERE length(key) >= 40)
      GROUP BY key HAVING count(*) >= 5),
m AS (SELECT k.*, f.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r"""


@query
def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (token_counts.vocabulary_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_tokenizers(table(spark, folder, "documents"), first, second)


@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened_components(table(spark, folder, "embeddings"))
