"""Distinct counts over any span of days, from one small sketch a day.

A day's values are summarised once; the sketches of a span's days are merged, which takes no look at the rows again.
Sketches that hold fewer than ``2 ** ACCURACY`` values are exact; beyond that the relative standard error is
``2 ** (-ACCURACY / 2)``. The exact form reads the rows of every span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ACCURACY = 12


def daily_sketches(df: DataFrame, time: str, value: str, *groups: str, accuracy: int = ACCURACY) -> DataFrame:
    """(``day``, groups, ``sketch``): worth storing, one row per day and group; null values count nowhere."""
    return df.groupBy(F.to_date(time).alias("day"), *groups).agg(F.theta_sketch_agg(value, accuracy).alias("sketch"))


def _days(spans: DataFrame) -> DataFrame:
    """``spans`` (``first_day``, ``last_day``) with each of their days; an empty span has none."""
    days = F.when(F.col("first_day") <= F.col("last_day"), F.sequence("first_day", "last_day"))
    return spans.select("first_day", "last_day").distinct().withColumn("day", F.explode(days))


def distinct_over(sketches: DataFrame, spans: DataFrame, *groups: str, accuracy: int = ACCURACY) -> DataFrame:
    """(``first_day``, ``last_day``, groups, ``values``): estimated distinct values of each span that has any rows."""
    joined = sketches.join(F.broadcast(_days(spans)), "day")
    merged = joined.groupBy("first_day", "last_day", *groups).agg(F.theta_union_agg("sketch", accuracy).alias("sketch"))
    return merged.select("first_day", "last_day", *groups, F.theta_sketch_estimate("sketch").alias("values"))


def exact_over(df: DataFrame, spans: DataFrame, time: str, value: str | Column, *groups: str) -> DataFrame:
    """The same columns, counted from the rows; a value is sent once per day at most."""
    values = df.select(F.to_date(time).alias("day"), *groups, (F.col(value) if isinstance(value, str) else value).alias("value_")).distinct()
    joined = values.join(F.broadcast(_days(spans)), "day")
    return joined.groupBy("first_day", "last_day", *groups).agg(F.count_distinct("value_").alias("values"))
