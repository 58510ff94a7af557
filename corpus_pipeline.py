"""From raw documents to token ids, in stages that each write a table for the next.

run(spark, sf_dir) applies STAGES to the table of documents. A stage takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import bpe, decontaminate, exact, jaccard, langid
from martwright.llm.shipping import ship
from martwright.session import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = "byte_bpe_multi_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach; those without letters or unlike all languages go."""
    ship(spark)
    return langid.in_known_language(docs).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, the document with the smallest id."""
    return exact.distinct_texts(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    ship(spark)
    return jaccard.one_of_each(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and whether these decode to the text."""
    ship(spark)
    both = bpe.encode(docs.select(*COLUMNS), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded="decoded")
    return both.select(
        *COLUMNS, "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding", token_ids),
]

ORACLE_SQL = None  # profiles, projections and merges are not SQL; tests/llm has the brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
