"""Queries over whole tables, one per operator, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywing.llm import (
    decontaminate, language, lattice, licences, lines, negatives, packing, partenum, pieces, quality, secrets, sql, suffixes, turns)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query(sql.LINES)
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What removing repeated multi-line chunks leaves of every document."""
    df = lines.drop_repeated_runs(documents(spark, sf).select("doc_id", "text"), report_col="report")
    return df.select("doc_id", "report.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query(sql.QUALITY)
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base counts and robust-outlier verdict of every document."""
    return quality.quality_verdicts(documents(spark, sf)).drop("outlyingness")


@query(sql.CONTAMINATION)
def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every document that stand in a test item's window."""
    df = decontaminate.contamination(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return df.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op6_harmonic_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(documents(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op5_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Component of every document under links of five-word shingle similarity 0.8 or more."""
    return partenum.link_components(documents(spark, sf).select("doc_id", "text"))


@query(sql.SECRETS)
def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of secrets in every document, by patterns and by entropy."""
    df = secrets.scan_secrets(documents(spark, sf).select("doc_id", "text")).drop("text")

    def joined(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.first, s.stop)), ',')"

    base = f"filter(secrets, s -> s.kind_no < {len(secrets.PATTERNS)})"
    return df.select(
        "doc_id", *(F.expr(f"cast(size(filter(secrets, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.PATTERNS),
        F.sha2(F.expr(joined(base)), 256).alias("base_sha256"), F.expr(joined("secrets")).alias("spans"))


@query(sql.LICENCES)
def op9_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Licences of every document, by rules over its sentences."""
    df = licences.scan_licences(documents(spark, sf).select("doc_id", "text"))
    return df.select("doc_id", "n_licence_sentences", F.size("licences").cast("bigint").alias("n_licences"),
                     F.array_join("licences", ",").alias("licences"))


@query()
def op10_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Word unigram and subword lattice scores of every document."""
    return lattice.score_texts(documents(spark, sf).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document by rank-order profiles."""
    return language.identify(documents(spark, sf).select("doc_id", "text", "lang"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without 400-byte strings that start elsewhere, too."""
    return suffixes.drop_repeated_strings(documents(spark, sf).select("doc_id", "text")).drop("kept")


@query()
def op11_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document by the piece vocabulary, and the text they decode to, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    df = pieces.decode_ids(pieces.encode_texts(documents(spark, sf).select("doc_id", "text"), model).select("doc_id", "ids"), model)
    return df.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                     F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))


@query(sql.TURNS)
def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Cheapest repair of every conversation after planted damage."""
    damaged = turns.damage(spark.read.parquet(f"{sf}/conversations.parquet"))
    return turns.repair(damaged, live_col="live")


@query(sql.NEGATIVES)
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after its label was changed for every seventh."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
