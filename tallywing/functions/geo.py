"""Coordinates held as text, and planar distance in degrees."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallywing.constants import COORDINATE_PATTERN, NULL_MARKER, UNKNOWN
from tallywing.functions.values import is_missing


def parse_pair(text: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of ``lat,lon`` text, brackets allowed; null when not numeric."""
    parts = F.split(F.translate(text, "[]", ""), ",")
    return tuple(F.get(parts, F.lit(i)).try_cast("double") for i in (0, 1))


def find_pair(text: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of the first number pair inside free text."""
    return tuple(F.regexp_extract(text, COORDINATE_PATTERN, i).try_cast("double") for i in (1, 2))


def coordinates(coord: Column, location: Column) -> tuple[Column, Column]:
    """From the coordinate field, or from the free-text location where that field is missing or a filler."""
    exact, found = parse_pair(coord), find_pair(location)
    return tuple(
        F.when(~is_missing(coord, (NULL_MARKER, UNKNOWN)), e).otherwise(f) for e, f in zip(exact, found)
    )


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return F.sqrt(dx * dx + dy * dy)


def is_finite(value: Column) -> Column:
    """False for null, NaN and both infinities."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))
