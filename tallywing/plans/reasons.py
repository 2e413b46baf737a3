"""Top complaint reasons per airline."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.functions.text import composite_key
from tallywing.operators.filters import with_reason
from tallywing.operators.ranking import top_per_group


def top_reasons(
    df: DataFrame,
    group: str = "airline",
    first: str = "negativereason1",
    second: str = "negativereason2",
    n: int = 5,
    one_per_count: bool = True,
) -> DataFrame:
    """(group, reason, n, rank) for the ``n`` most frequent usable reasons."""
    return top_per_group(with_reason(df, group, first, second), group, "reason", n, one_per_count)


def render_reasons(top: DataFrame, group: str = "airline") -> DataFrame:
    """(group, reason_count) with the count appended to the reason, best first per group."""
    return top.orderBy(group, "rank").select(
        group, composite_key(F.col("reason"), F.col("n").cast("string")).alias("reason_count")
    )
