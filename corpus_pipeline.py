"""From raw documents to a training mix, one stage after the other.

Documents without a language go; of lines that many sources share the first occurrence
stays; of near duplicates one document stays; documents that hold a benchmark item go;
what is left is mixed to source weights, one row per copy taken.

Stages read and return ``doc_id, text, lang, source, n_chars``; further columns of the input
stay behind. A null or empty text has no language and goes in the first stage. A null ``source``
is a source of its own, a null ``lang`` is not learned from, and a null ``doc_id`` is an id like
others: of rows with equal texts one stays. Repeated rows are near duplicates of each other. An
empty table gives empty results at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorferry.llm import decontaminate, language, lines, minhash, mixing
from vectorferry.llm.store import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Language spans, signature buckets and tiles cannot be expressed in SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the languages given; texts without a letter, or whose words read as letters at random, go."""
    return language.drop_unidentified(docs, language.train(docs)).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines stay only where they stand first; a text of which nothing else is left goes."""
    cleaned = lines.dedup_lines(docs.select(*COLUMNS))
    left = F.coalesce(F.col("n_removed") < F.col("n_lines"), F.lit(True)) | (F.col("n_removed") == 0)
    return cleaned.filter(left).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return minhash.drop_near_duplicates(docs.select(*COLUMNS))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1, repeating; one row per copy taken."""
    mixed = mixing.mix_sources(docs.select(*COLUMNS))
    return mixing.emit(mixed).select(*COLUMNS, "copy", "size", "target")


STAGES = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate_benchmark),
    ("mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
