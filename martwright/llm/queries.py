"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import bpe, chat, counts, decontaminate, divergence, exact, jaccard, langid, lm, merkle, neighbours, tokenfiles, urls
from martwright.llm.shipping import ship

BYTE_RANKS, WORD_MODEL, PIECE_MODEL = "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"
END_ID = 2
TOKEN_LIMIT = 4096
KEPT_FROM, BEST_TERMS, NEAREST = 10, 10, 20  # documents of a language that a term is in; terms of a source; neighbours
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text", *more)


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    both = bpe.encode(_texts(spark, folder), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = tokenfiles.write_and_read(spark, _texts(spark, folder), public_tokenizers.path(WORD_MODEL), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(_table(spark, folder, "conversations"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(_texts(spark, folder), _table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder).withColumn("held_out", lm.held_out())
    return lm.score(docs, lm.train(docs.filter("not held_out"))).drop("text")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder, "lang").withColumn("held_out", langid.held_out())
    profiles = langid.learn(docs.filter("not held_out"))
    return langid.predict(docs.drop("lang"), profiles).drop("text")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.deduplicate(_texts(spark, folder))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_texts(spark, folder))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder).withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = counts.token_counts(docs, public_tokenizers.path(PIECE_MODEL), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fitting_chars")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest_of("doc_id", "source", "lang", "n_chars", lower))
    rows = merkle.manifest(_table(spark, folder, "documents"), fields, "lang", "doc_id", {"doc_id": F.col("doc_id"), "tampered": tampered})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(_table(spark, folder, "documents").select("lang", "source", "text"), KEPT_FROM, BEST_TERMS)


def op13_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), NEAREST)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe, op2_token_files, op3_chat_format, op4_decontaminate, op5_lm_score, op6_language, op7_exact_dedup, op8_jaccard_join,
        op9_token_counts, op10_url_filter, op11_manifest, op12_divergence, op13_nearest)}
