"""The tables behind the report charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallywing.constants import SENTIMENTS
from tallywing.operators.joins import join_lookup
from tallywing.operators.ranking import counts, top_lists
from tallywing.operators.stats import pivot_counts, share_of_total, summarize


def sentiment_counts(df: DataFrame, group: str, label: str = "airline_sentiment") -> DataFrame:
    """(group, label, sentiment_count), largest first."""
    tally = counts(df, group, label, name="sentiment_count")
    return tally.orderBy(F.desc("sentiment_count"), group, label)


def sentiment_pivot(
    df: DataFrame, group: str, label: str = "airline_sentiment", values: Sequence[str] = SENTIMENTS
) -> DataFrame:
    """One row per group, one count per sentiment."""
    return pivot_counts(df, group, label, values).orderBy(group)


def sentiment_share(df: DataFrame, group: str, label: str = "airline_sentiment", value: str = "positive") -> DataFrame:
    """Share of each group in all rows with one sentiment."""
    return share_of_total(df.filter(F.col(label) == value), group).orderBy(F.desc("n"), group)


def daily_counts(df: DataFrame, time: str = "tweet_created", label: str = "airline_sentiment") -> DataFrame:
    """(day, label, n) in date order."""
    return counts(df.withColumn("day", F.to_date(time)), "day", label).orderBy("day", label)


def daily_pivot(
    df: DataFrame, time: str = "tweet_created", label: str = "airline_sentiment", values: Sequence[str] = SENTIMENTS
) -> DataFrame:
    """One row per day, one count per sentiment, in date order."""
    return pivot_counts(df.withColumn("day", F.to_date(time)), "day", label, values).orderBy("day")


def country_heat(
    df: DataFrame, countries: DataFrame, label: str = "airline_sentiment", value: str = "negative", code: str = "iso3"
) -> DataFrame:
    """(code, latitude, longitude, n) for one sentiment, largest first; counted before the lookup."""
    tally = counts(df.filter(F.col(label) == value), code)
    places = countries.select(code, "latitude", "longitude")
    return join_lookup(tally, places, code, "left").select(code, "latitude", "longitude", "n").orderBy(F.desc("n"), code)


def group_profile(
    df: DataFrame, group: str = "airline", value: str = "_trust", reason: str = "negativereason1", n: int = 5
) -> DataFrame:
    """Trust statistics of each group next to its top reasons."""
    return summarize(df, group, value).join(top_lists(df, group, reason, n, "top_reasons"), group, "inner")


def totals(df: DataFrame, group: str = "airline", value: str = "retweet_count", name: str = "total") -> DataFrame:
    return df.groupBy(group).agg(F.sum(value).alias(name))
