"""A training-corpus pipeline: each stage takes the documents that its predecessor kept.

``run`` writes every stage as Parquet under the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecflow.deploy import ship_package
from vecflow.llm import contamination, language, near_copies, packing, repeats
from vecflow.llm.common import remainder
from vecflow.llm.token_counts import vocabulary_path
from vecflow.scratch import TEXTS, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is rejected if no learned language has at least this posterior.
LEAST_LANGUAGE_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or without a clear language go."""
    ship_package(spark)
    path = vocabulary_path("piece_bpe_32k.model")
    model = language.train(docs, remainder(F.col("doc_id"), 3) != 1, path)
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return language.identify(docs.select(*COLUMNS), model).where(known).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies: that with the smallest id, one without an id only where no row of the
    class has one. Each row is a document of its own, also where rows repeat, share an id or have none."""
    ship_package(spark)
    rows = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows", TEXTS)
    classes = near_copies.near_copies(rows.select(F.col("row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("row"), "class_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row"))
    kept = classes.groupBy("class_id").agg(first.alias("first")).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that occur more than once. A document of which nothing is left goes."""
    ship_package(spark)
    left = repeats.remove_repeats(docs.select(*COLUMNS))
    left = left.where((F.col("n_removed") == 0) | (F.col("text") != ""))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    return contamination.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, and their places in sequences."""
    ship_package(spark)
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identified),
    ("near_dedup", one_of_each),
    ("suffix_dedup", without_repeats),
    ("decontamination", uncontaminated),
    ("packing", packed),
]
#: The stages hash, learn and align, which SQL cannot express; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name, TEXTS)
    return STAGES[-1][1](spark, docs, sf_dir)
