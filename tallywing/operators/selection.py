"""Exact order statistics per group by radix selection, however large a group or its number of distinct values.

Every value has a code that grows with it: its sign and logarithm in steps of 1/16 octave. A first pass counts, per
group, how many values have each code; partial counts are added up before the shuffle, so a group with most of the
rows reaches its reducer as some thousand rows. The code that holds a wanted position becomes its interval. Each further
pass splits the open intervals into ``SPLITS`` parts of equal width and goes on with the part that holds the position,
narrowed to the values met in it. An interval that holds one value, or few rows, is finished by counting its values.

Codes and parts need only to grow with the value, so rounding cannot change a result. Doubles have 53 bits; a pass
settles 16 of them, so four passes end every search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywing.operators.joins import join_lookup
from tallywing.session import settle

SPLITS = 1 << 16
#: Rows of an interval that are counted value by value.
FEW = 10_000
_STEPS, _SHIFT = 16, 1100


def code(value: Column) -> Column:
    """A whole number that grows with a double; NaN comes last, as in Spark's own order."""
    size = F.floor((F.log2(F.abs(value)) + _SHIFT) * _STEPS).cast("int")
    most = 3000 * _STEPS
    return (
        F.when(F.isnan(value), most + 1).when(value == float("inf"), most).when(value == float("-inf"), -most)
        .when(value > 0, size).when(value < 0, -size).otherwise(0))


def _part(value: Column, low: Column, high: Column) -> Column:
    """The part of an interval that a value falls into."""
    # Values of one code have one sign and differ by a factor below two, so the differences are exact.
    share = (value - low) / (high - low)
    return F.when(low == high, 0).otherwise(F.least(F.floor(share * SPLITS), F.lit(SPLITS - 1)).cast("int"))


def _locate(tally: DataFrame, wanted: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The interval of each wanted position: ``tally`` counts rows of ``keys`` per ``by`` with least and greatest value."""
    running = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    placed = tally.withColumn("upto_", F.sum("n_").over(running))
    here = (F.col("upto_") - F.col("n_") < F.col("rank_")) & (F.col("upto_") >= F.col("rank_"))
    return (
        join_lookup(placed, wanted, keys, "inner").filter(here)
        .select("g_", "at_", (F.col("rank_") - F.col("upto_") + F.col("n_")).alias("rank_"), F.col("min_").alias("low_"),
                F.col("max_").alias("high_"), "n_"))


def code_counts(rows: DataFrame, *more: Column) -> DataFrame:
    """(``g_``, ``code_``, ``n_``, ``min_``, ``max_`` and ``more`` aggregates) of rows (``g_``, ``v_``); nulls have no code."""
    return rows.groupBy("g_", F.when(F.col("v_").isNotNull(), code(F.col("v_"))).alias("code_")).agg(
        F.count("v_").alias("n_"), F.min("v_").alias("min_"), F.max("v_").alias("max_"), *more)


def order_statistics(rows: DataFrame, wanted: DataFrame, tally: DataFrame | None = None, few: int = FEW) -> DataFrame:
    """(``g_``, ``at_``, ``value_``): the value at each wanted position of its group.

    ``rows`` is (``g_``, ``v_``) with ``v_`` double; ``wanted`` is (``g_``, ``at_``, ``rank_``), positions from 1, not more
    than the group has values. A group that may be null is given as a struct. ``tally`` passes on :func:`code_counts` already made.
    """
    known = rows.select("g_", "v_").filter(F.col("v_").isNotNull())
    tally = code_counts(known) if tally is None else tally.filter(F.col("code_").isNotNull())
    open_ = settle(_locate(tally, wanted, ["g_"], "code_"))
    same = F.col("low_").eqNullSafe(F.col("high_"))
    done = [open_.filter(same).select("g_", "at_", F.col("low_").alias("value_"))]
    open_ = open_.filter(~same)
    while True:
        large = open_.filter(F.col("n_") > few)
        if large.isEmpty():
            break
        # Positions in one interval share its counts.
        spans = large.select("g_", "low_", "high_").distinct()
        inside = (
            join_lookup(known, spans.groupBy("g_").agg(F.collect_set(F.struct("low_", "high_")).alias("spans_")), "g_", "inner")
            .withColumn("span_", F.explode("spans_")).filter((F.col("v_") >= F.col("span_.low_")) & (F.col("v_") <= F.col("span_.high_"))))
        parts = inside.groupBy("g_", "span_", _part(F.col("v_"), F.col("span_.low_"), F.col("span_.high_")).alias("part_")).agg(
            F.count("*").alias("n_"), F.min("v_").alias("min_"), F.max("v_").alias("max_"))
        asked = large.select("g_", "at_", "rank_", F.struct("low_", "high_").alias("span_"))
        found = settle(_locate(parts, asked, ["g_", "span_"], "part_"))
        done.append(found.filter(same).select("g_", "at_", F.col("low_").alias("value_")))
        open_ = settle(open_.filter(F.col("n_") <= few).unionByName(found.filter(~same)))
    # What is left has few rows to each interval.
    per_group = open_.groupBy("g_").agg(F.collect_set(F.struct("low_", "high_")).alias("spans_"))
    values = (
        join_lookup(known, per_group, "g_", "inner").withColumn("span_", F.explode("spans_"))
        .filter((F.col("v_") >= F.col("span_.low_")) & (F.col("v_") <= F.col("span_.high_")))
        .groupBy("g_", "span_", "v_").agg(F.count("*").alias("n_")).select("*", F.col("v_").alias("min_"), F.col("v_").alias("max_")))
    last = _locate(values, open_.select("g_", "at_", "rank_", F.struct("low_", "high_").alias("span_")), ["g_", "span_"], "v_")
    done.append(last.select("g_", "at_", F.col("low_").alias("value_")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
