"""Row validity filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tallywing.constants import NULL_MARKER, SENTIMENTS, UNKNOWN
from tallywing.functions.values import choose_reason, is_missing


def known_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every column holds a real value: not null, not ``NULL``, not ``Unknown``."""
    for c in columns:
        df = df.filter(~F.col(c).isin(NULL_MARKER, UNKNOWN))
    return df


def in_domain(df: DataFrame, column: str, domain: Iterable[str] = SENTIMENTS) -> DataFrame:
    """Rows whose value belongs to the domain, ignoring case."""
    return df.filter(F.upper(column).isin(*[v.upper() for v in domain]))


def equals_ignoring_case(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.upper(column) == value.upper())


def with_reason(
    df: DataFrame,
    group: str,
    first: str,
    second: str,
    name: str = "reason",
    fallback_markers: Iterable[str] = (UNKNOWN,),
) -> DataFrame:
    """Add the reason that counts for a row; drop rows without a group or a usable reason.

    A row qualifies when its group is known and at least one reason is. The second reason replaces
    only a first one that is a fallback marker, so a blank first reason still drops the row unless
    ``fallback_markers`` says otherwise.
    """
    usable = ~is_missing(F.col(group)) & ~(
        is_missing(F.col(first), (NULL_MARKER, UNKNOWN)) & is_missing(F.col(second), (NULL_MARKER, UNKNOWN))
    )
    chosen = choose_reason(
        F.coalesce(F.col(first), F.lit("")), F.coalesce(F.col(second), F.lit("")), fallback_markers
    )
    return (
        df.filter(usable)
        .withColumns({group: F.trim(group), name: chosen})
        .filter(~is_missing(F.col(name)))
    )
