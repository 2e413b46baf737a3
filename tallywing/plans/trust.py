"""Worker trust per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.operators.stats import summarize


def trust_by_channel(
    df: DataFrame, channel: str = "_channel", trust: str = "_trust", approximate: bool = False
) -> DataFrame:
    return summarize(df, channel, trust, approximate).select(
        channel,
        F.col("mean").alias("mean_trusting_points"),
        F.col("median").alias("median_trusting_points"),
    )
