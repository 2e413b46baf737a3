"""Cleaning pipeline: raw feedback rows to the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from tallywing.constants import CLEAN_DROP, DEDUP_KEYS, TWEET_TIME_FORMATS, UNKNOWN, WORK_TIME_FORMATS
from tallywing.functions.text import replace_control, single_quotes, split_items
from tallywing.functions.timestamps import parse_minute
from tallywing.functions.values import marker_to_null, override
from tallywing.operators.cleaning import (
    dedup, drop_if_missing, fill_constants, fill_global_mode, fill_group_mode, fill_mean, require_columns)
from tallywing.session import stage
from tallywing.sources.sinks import observed


def parse_times(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "tweet_created": parse_minute(F.col("tweet_created"), TWEET_TIME_FORMATS),
        "_created_at": parse_minute(F.col("_created_at"), WORK_TIME_FORMATS),
        "_started_at": parse_minute(F.col("_started_at"), WORK_TIME_FORMATS),
    })


def normalise_text(df: DataFrame, line_break: str = "") -> DataFrame:
    return df.withColumn("text", single_quotes(replace_control(F.col("text"), line_break)))


def normalise_reason(df: DataFrame, line_break: str = ",") -> DataFrame:
    """Line breaks inside the trusted reason, which stand between its items, as ``line_break``."""
    return df.withColumn("negativereason_gold", replace_control(F.col("negativereason_gold"), line_break))


def reconcile_labels(df: DataFrame) -> DataFrame:
    """Trusted labels win; trusted reasons become two columns, backed by the crowd's reason."""
    first, second = split_items(F.col("negativereason_gold"), 2)
    return df.withColumns({
        "airline_sentiment": override(F.col("airline_sentiment_gold"), F.col("airline_sentiment")),
        "negativereason1": F.coalesce(first, F.col("negativereason")),
        "negativereason2": second,
    })


def clean_feedback(
    raw: DataFrame,
    drop: Sequence[str] = CLEAN_DROP,
    fill: bool = True,
    line_break: str = "",
    require_location: bool = False,
    dedup_keys: Sequence[str] = DEDUP_KEYS,
    null_columns: Sequence[str] = (),
    zone_by: str | None = "_country",
    mean_retweets: bool = False,
    reason_break: str | None = None,
    watch: dict[str, Observation] | None = None,
) -> DataFrame:
    """Deduplicate, parse, reconcile and fill the 27-column feedback table.

    ``line_break`` replaces line breaks and tabs in the text, ``reason_break`` those in the trusted reason, if that
    column is kept. ``fill`` fills the gold label, country and time zone: the zone by the most common one of the
    row's ``zone_by``, or of all rows if that is None. In ``null_columns`` the text ``NULL`` counts as missing before
    anything is filled. ``mean_retweets`` fills that count with its mean instead of 0. ``require_location`` drops rows with
    neither location nor coordinates and fills the one that is missing.

    The deduplication on ``dedup_keys`` is the one shuffle of whole rows. With ``fill`` its result is written once,
    because both the zone statistics and the output need it. ``watch`` receives observations: ``read`` and ``kept``
    (``rows`` before and after deduplication) and ``filled`` (``zones`` that were filled), gathered in these passes.
    """
    raw = require_columns(raw, dedup_keys)
    if watch is not None:
        raw, watch["read"] = observed(raw)
    rows = dedup(raw, dedup_keys)
    if watch is not None:
        rows, watch["kept"] = observed(rows)
    rows = rows.withColumns({c: marker_to_null(F.col(c)) for c in null_columns})
    rows = rows.transform(parse_times).transform(normalise_text, line_break).transform(reconcile_labels)
    if reason_break is not None:
        rows = normalise_reason(rows, reason_break)
    if require_location:
        rows = drop_if_missing(rows, ["tweet_location", "tweet_coord"], "all")
        rows = fill_constants(rows, {"tweet_location": UNKNOWN, "tweet_coord": UNKNOWN})
    rows = fill_constants(rows, {"negativereason1": UNKNOWN, "negativereason2": UNKNOWN, "_missed": False})
    rows = rows.drop(*drop)
    if not mean_retweets:
        rows = fill_constants(rows, {"retweet_count": 0})
    if not (fill or mean_retweets):
        return rows
    rows = stage(rows, "deduplicated")
    if mean_retweets:
        rows = fill_mean(rows, "retweet_count")
    if fill:
        rows = fill_constants(rows, {"airline_sentiment_gold": UNKNOWN, "_country": UNKNOWN})
        if watch is not None:
            rows, watch["filled"] = observed(rows, zones=F.count_if(F.col("user_timezone").isNull()))
        if zone_by is None:
            rows = fill_constants(fill_global_mode(rows, "user_timezone"), {"user_timezone": UNKNOWN})
        else:
            rows = fill_group_mode(rows, zone_by, "user_timezone", UNKNOWN)
    return rows
