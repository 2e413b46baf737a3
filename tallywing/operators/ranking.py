"""Counts ranked globally or per group; every ranking has a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key combination."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def top_per_group(df: DataFrame, group: str, value: str, n: int = 5, one_per_count: bool = False) -> DataFrame:
    """The ``n`` most frequent values per group, with their counts and ranks.

    ``one_per_count``: values with equal counts share one place, held by the greatest value.
    Otherwise all values rank, ties in value order.
    """
    tally = counts(df, group, value)
    if one_per_count:
        tally = tally.groupBy(group, "n").agg(F.max(value).alias(value))
    order = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(value))
    ranked = tally.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n).select(group, value, "n", "rank")


def top_lists(df: DataFrame, group: str, value: str, n: int = 5, name: str = "top_values") -> DataFrame:
    """The ``n`` most frequent non-null values per group as one array, best first.

    Only ``n`` values per group are ever collected; a group without a value has an empty array.
    """
    top = top_per_group(df.filter(F.col(value).isNotNull()), group, value, n)
    pairs = F.array_sort(F.collect_list(F.struct("rank", value)))
    lists = top.groupBy(group).agg(F.transform(pairs, lambda p: p[value]).alias(name))
    empty = df.groupBy(group).agg(F.count(value).alias("_n")).filter("_n = 0").select(group, F.expr("array()").cast(lists.schema[name].dataType).alias(name))
    return lists.unionByName(empty)


def top_n(df: DataFrame, key: str, n: int, name: str = "n") -> DataFrame:
    """The ``n`` most frequent keys, ties in key order; ``-1`` returns all, ``0`` none."""
    if n < -1:
        raise ValueError("n must be -1 (all) or at least 0")
    ranked = counts(df, key, name=name).orderBy(F.desc(name), F.asc(key))
    return ranked if n == -1 else ranked.limit(n)


def most_common(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-null value and its count; ties by value."""
    return counts(df.filter(F.col(column).isNotNull()), column).orderBy(F.desc("n"), F.asc(column)).limit(1)


def most_common_per(df: DataFrame, group: str, column: str) -> DataFrame:
    """Per group, the most frequent non-null value and its count; ties by value."""
    known = df.filter(F.col(column).isNotNull())
    return top_per_group(known, group, column, 1).drop("rank")
