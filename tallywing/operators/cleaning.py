"""Deduplication, missing-value filling, and schema operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywing.constants import UNKNOWN
from tallywing.operators.joins import join_lookup
from tallywing.operators.naming import free
from tallywing.operators.ranking import most_common, most_common_per
from tallywing.session import settle


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` itself, or an error naming the columns it lacks (names compare case-insensitively)."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def stable_key(*columns: Column) -> Column:
    """A row key that is the same in every evaluation, from identifying columns.

    Each value is written with its length and null as ``-``, so different rows never read the same.
    """
    parts = [F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key: the first in ``order_by`` (default: all other columns), so runs agree.

    Each task keeps one row per key before the shuffle, so many copies of one row cost nothing there.
    """
    order = order_by or [c for c in df.columns if c not in set(keys)] or [F.lit(1)]
    (place,) = free(df, "place_")
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) == 1).drop(place)


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before and after deduplication on ``keys``."""
    key = F.struct(*keys)
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_distinct(key).alias("rows_after"),
    )


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Nulls become the column mean; the column becomes double."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), mean))


def fill_global_mode(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), most_common(df, column).select(column).scalar()))


def fill_group_mode(df: DataFrame, group: str, column: str, default: str = UNKNOWN) -> DataFrame:
    """Nulls become the most common value of the row's group, else ``default``.

    Filling the column with a constant first would leave nothing to fill here.
    """
    (mode,) = free(df, "mode_")
    modes = settle(most_common_per(df, group, column).select(group, F.col(column).alias(mode)))
    joined = join_lookup(df, modes, group, "left")
    filled = F.coalesce(F.col(column), F.col(mode), F.lit(default))
    return joined.withColumn(column, filled).select(*df.columns)


def drop_if_missing(df: DataFrame, columns: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows where any / all of the columns are null. Apply before filling them."""
    return df.dropna(how=how, subset=list(columns))


def union_tables(*tables: DataFrame) -> DataFrame:
    """Concatenate by column name; a column some tables lack is null there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out
