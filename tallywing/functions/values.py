"""Missing values, label reconciliation and conditional choices."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tallywing.constants import NULL_MARKER, THRESHOLD, UNKNOWN


def is_missing(value: Column, markers: Iterable[str] = (NULL_MARKER,)) -> Column:
    """Null, blank, or one of the spellings of missing. Never null itself."""
    trimmed = F.trim(value)
    return F.coalesce(trimmed.isin("", *markers), F.lit(True))


def marker_to_null(value: Column, marker: str = NULL_MARKER) -> Column:
    return F.nullif(value, F.lit(marker))


def override(gold: Column, label: Column) -> Column:
    """The trusted label where there is one, else the crowd label.

    Apply before filling ``gold``: a filler would count as trusted.
    """
    return F.coalesce(gold, label)


def same_value(a: Column, b: Column) -> Column:
    """1 where both are present and equal, else 0."""
    return F.coalesce((a == b).cast("int"), F.lit(0))


def choose_reason(first: Column, second: Column, fallback_markers: Iterable[str] = (UNKNOWN,)) -> Column:
    """The second reason where the first is a fallback marker and the second is not ``NULL``."""
    use_second = F.trim(first).isin(*fallback_markers) & (F.trim(second) != NULL_MARKER)
    return F.when(use_second, F.trim(second)).otherwise(F.trim(first))


def label_by_threshold(score: Column, threshold: float = THRESHOLD) -> Column:
    """positive / negative / neutral; a score on the edge is not neutral. Null stays null."""
    return (
        F.when(score >= threshold, "positive")
        .when(score <= -threshold, "negative")
        .when(score.isNotNull(), "neutral")
    )
