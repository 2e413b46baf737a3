"""A corpus pipeline: every stage works on all rows its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywing.llm import decontaminate, lines, packing, partenum, quality
from tallywing.llm.common import release
from tallywing.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; every document stays, and ``n_chars`` counts what is left of it."""
    found = lines.drop_repeated_runs(docs)
    out = found.withColumn("n_chars", F.length("text").cast("bigint"))
    out.staged_path = found.staged_path
    return out


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect, the one with the least id stays."""
    return partenum.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a test item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, as pieces in sequences of 4096 tokens.

    The executors' heaps are full from the stages before, so workers remember fewer words than ``pack`` lets them.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=300_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("harmonic_packing", harmonic_packing),
]

#: SQL cannot express the tokenizer of the last stage; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        release(out)
        docs = spark.read.parquet(path)
    return docs
