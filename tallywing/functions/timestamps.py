"""Timestamp expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def parse_minute(text: Column, formats: Iterable[str]) -> Column:
    """The first layout that fits, cut to the minute; null when none fits."""
    tries = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    return F.date_trunc("minute", F.coalesce(*tries))
