"""Grouped statistics and data-quality summaries; each is one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.constants import NULL_MARKER
from tallywing.operators.joins import join_lookup
from tallywing.operators.ranking import counts
from tallywing.operators.selection import code_counts, order_statistics
from tallywing.session import settle

SKETCH_ACCURACY = 10_000


def summarize(df: DataFrame, group: str, value: str, approximate: bool = False) -> DataFrame:
    """mean, median, count, min, max of ``value`` per group; nulls are ignored, all groups kept.

    The exact median comes from radix selection (:mod:`tallywing.operators.selection`): no group is ever held in one
    task, as Spark's own ``median`` would, and the first pass serves all five. ``approximate`` takes the answer of a
    sketch instead, in one pass.
    """
    raw = F.col("raw_")
    rows = df.select(F.struct(F.col(group).alias("key")).alias("g_"), F.col(value).cast("double").alias("v_"), F.col(value).alias("raw_"))
    if approximate:
        middle = F.percentile_approx("v_", 0.5, SKETCH_ACCURACY)
        done = rows.groupBy("g_").agg(F.avg("v_").alias("mean"), middle.alias("median"), F.count("v_").alias("count"),
                                      F.min(raw).alias("min"), F.max(raw).alias("max"))
    else:
        tally = settle(code_counts(rows, F.sum("v_").alias("sum_"), F.min(raw).alias("least_"), F.max(raw).alias("most_")))
        summary = tally.groupBy("g_").agg((F.sum("sum_") / F.nullif(F.sum("n_"), F.lit(0))).alias("mean"), F.sum("n_").alias("count"),
                                          F.min("least_").alias("min"), F.max("most_").alias("max"))
        medians = exact_medians(rows, summary.select("g_", F.col("count").alias("n_")), tally)
        done = join_lookup(summary, medians, "g_", "left")
    return done.select(F.col("g_.key").alias(group), "mean", "median", "count", "min", "max")


def exact_medians(rows: DataFrame, sizes: DataFrame, tally: DataFrame | None = None) -> DataFrame:
    """(``g_``, ``median``) of rows (``g_``, ``v_``); ``sizes`` is (``g_``, ``n_``), the values of each group."""
    middles = F.array(F.floor((F.col("n_") + 1) / 2), F.floor((F.col("n_") + 2) / 2))
    wanted = sizes.filter("n_ > 0").select("g_", F.posexplode(middles).alias("at_", "rank_"))
    found = order_statistics(rows, wanted, tally)
    # Halved before they are added, so that two great values stay finite.
    both = F.min("value_") / 2 + F.max("value_") / 2
    return found.groupBy("g_").agg(F.when(F.min("value_") == F.max("value_"), F.min("value_")).otherwise(both).alias("median"))


def share_of_total(df: DataFrame, *keys: str) -> DataFrame:
    """Count per key and its percentage of all rows."""
    tally = settle(counts(df, *keys))
    total = tally.agg(F.sum("n")).scalar()
    return tally.withColumn("percent", F.col("n").cast("double") * 100 / total)


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """One row per ``row``, one count column per listed value (0 where absent)."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return counts(df.filter(F.col(column).isNotNull()), column)


def distinct_ratio(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """One row: distinct non-null values, rows, and their ratio."""
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(F.col(column))
    out = df.agg(distinct.alias("distinct_values"), F.count("*").alias("rows"))
    return out.withColumn("ratio", F.col("distinct_values").cast("double") / F.col("rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for each column that has nulls."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "nulls").filter("nulls > 0")


def missing_count(column: Column, marker: str = NULL_MARKER) -> Column:
    """Aggregate: rows that are null or hold the marker."""
    return F.count_if(column.isNull() | (column == marker))


def nonfinite_check(df: DataFrame, *columns: str) -> DataFrame:
    """One row: does any of the columns hold a NaN / an infinity?"""
    tests = []
    for c in columns:
        value = F.col(c)
        tests += [
            F.coalesce(F.bool_or(F.isnan(value)), F.lit(False)).alias(f"{c}_nan"),
            F.coalesce(F.bool_or(F.abs(value) == float("inf")), F.lit(False)).alias(f"{c}_inf"),
        ]
    return df.agg(*tests)


def disagreements(df: DataFrame, gold: str, label: str) -> DataFrame:
    """Rows whose trusted label is present and differs."""
    return df.filter(F.col(gold).isNotNull() & (F.col(gold) != F.col(label)))


def agreement(df: DataFrame, gold: str, label: str) -> DataFrame:
    """One row: matching labels and rows with a trusted label."""
    return df.agg(
        F.count_if(F.col(gold) == F.col(label)).alias("matching"),
        F.count(gold).alias("with_gold"),
    )
