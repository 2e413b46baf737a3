"""Lookup, anti and nearest-neighbour joins.

A side is broadcast only after its size was measured; beyond the bound the same join runs shuffled, with
keys measured to be hot spread over several tasks (:mod:`tallywing.operators.skew`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.functions.geo import is_finite, planar_distance
from tallywing.operators.celltree import build_tree, search_tree
from tallywing.operators.naming import free
from tallywing.operators.skew import any_null, salted_join
from tallywing.session import settle, stage

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a lookup by one aggregation over all its rows, merged from each task's sums."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in lookup.columns), F.lit(0))
    rows, size = (
        lookup.select(width.cast("long").alias("w"))
        .agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salt_by: Sequence[str] | None = None,
    small: bool | None = None,
    hot: dict[str, int] | None = None,
) -> DataFrame:
    """Join a large table to a lookup on equally named key columns (``left`` or ``inner``).

    A lookup that is not just a scan should be staged or settled first: it is read to be measured and again to be
    joined. ``small`` and ``hot`` pass on measurements already made; ``salt_by`` names the columns whose values spread
    the rows of a hot key in the shuffled form (default: all).
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, max_rows) if small is None else small:
        return facts.join(F.broadcast(lookup), keys, how)
    return salted_join(facts, lookup, keys, how, hot, salt_by)


#: Rows of the frequent keys' lookup. Of words, half a million cover all but some hundredths of a corpus.
FREQUENT_ROWS = BROADCAST_ROWS // 2
#: Steps into which a doubling of a key's count is cut.
LEVELS_PER_DOUBLING = 8


def frequent_keys(facts: DataFrame, keys: Sequence[str], max_rows: int, max_bytes: int) -> DataFrame:
    """The most frequent keys of ``facts``, as many as both bounds allow; keys that occur once are left out.

    Counts add up before the shuffle. The driver gets one row for each level of counts, some hundred whatever the table.
    """
    size, level = free(list(keys), "n_", "level_")
    counts = facts.filter(~any_null(keys)).groupBy(*keys).agg(F.count("*").alias(size)).filter(F.col(size) > 1)
    counts = settle(counts.select(*keys, F.floor(F.log2(size) * LEVELS_PER_DOUBLING).alias(level)))
    width = sum((F.octet_length(F.col(k).cast("string")) + 8 for k in keys), F.lit(0)).cast("long")
    levels = counts.groupBy(level).agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).orderBy(F.desc(level)).collect()
    rows = size_ = 0
    least = None
    for found in levels:
        rows, size_ = rows + found["rows"], size_ + found["bytes"]
        if rows > max_rows or size_ > max_bytes:
            break
        least = found[level]
    return counts.filter(F.col(level) >= F.lit(least) if least is not None else F.lit(False)).select(*keys)


def join_by_frequency(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], max_rows: int = FREQUENT_ROWS,
                      counted: DataFrame | None = None) -> DataFrame:
    """Left join to a lookup that may be beyond the broadcast bound, for keys of which few hold most rows, as words do.

    The frequent keys' lookup rows are broadcast, so only rows of rare keys are shuffled; no rare key holds many rows.
    ``facts`` is computed twice rather than written: meant for rows that come from a scan by expressions. ``counted``
    is a cheaper table with the same keys, as often, if there is one. The lookup should be staged or settled.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), keys, "left")
    known = frequent_keys(facts if counted is None else counted, keys, max_rows, BROADCAST_BYTES // 2)
    (mark,) = free([*facts.columns, *lookup.columns], "known_")
    theirs = lookup.join(F.broadcast(known), keys, "left_semi")
    common = settle(known.join(theirs, keys, "left").withColumn(mark, F.lit(True)))
    seen = facts.join(F.broadcast(common), keys, "left")
    rare = F.col(mark).isNull() & ~any_null(keys)
    return seen.filter(~rare).drop(mark).unionByName(seen.filter(rare).select(*facts.columns).join(lookup, keys, "left"))


def without_match(rows: DataFrame, resolved: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``resolved``."""
    return rows.join(resolved, on, "left_anti")


def first_per_key(lookup: DataFrame, key: str, order: str) -> DataFrame:
    """One row per lookup key, the one with the smallest ``order``, ties by all other columns."""
    rest = [c for c in lookup.columns if c != key]
    return (
        lookup.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(order, *rest)).alias("_kept"))
        .select(key, "_kept.*")
    )


NEIGHBOURS = 9
# Targets one point may have to look at in the widest search before rows are used instead of lists.
LIST_BOUND = 1_000


def _cell(value: Column, size: float) -> Column:
    # A hair over the search radius: neighbours exactly one radius apart stay in adjacent cells.
    return F.floor(value / F.lit(size * (1 + 1e-9)))


def _fullest_cells(places: DataFrame, reach: float, max_halvings: int) -> dict[int, int]:
    """Targets in the fullest cell for each number of halvings of the cell size; one small job."""
    level = F.explode(F.sequence(F.lit(0), F.lit(max_halvings))).alias("level")
    size = F.lit(reach * (1 + 1e-9)) / F.pow(F.lit(2.0), F.col("level"))
    fullest = (
        places.select("_tx", "_ty", level)
        .groupBy("level", F.floor(F.col("_tx") / size).alias("cx"), F.floor(F.col("_ty") / size).alias("cy"))
        .count()
        .groupBy("level")
        .agg(F.max("count").alias("fullest"))
    )
    return {r["level"]: r["fullest"] for r in fullest.collect()}


def _search_radii(fullest: dict[int, int], reach: float, crowd: int) -> list[float]:
    """Radii to try, small to large: halved until no cell of that size holds over ``crowd`` targets."""
    halvings = next((k for k in sorted(fullest) if fullest[k] <= crowd), max(fullest, default=0))
    return [reach / 2**k for k in range(halvings, -1, -1)]


def _neighbour_cells(places: DataFrame, radius: float) -> DataFrame:
    """Each target once per cell from which it can be seen: its own and the eight around."""
    offsets = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    return (
        places.withColumn("_dx", F.explode(offsets))
        .withColumn("_dy", F.explode(offsets))
        .select(
            (_cell(F.col("_tx"), radius) + F.col("_dx")).alias("_cx"),
            (_cell(F.col("_ty"), radius) + F.col("_dy")).alias("_cy"),
            "_tx", "_ty", "_target",
        )
    )


def nearest_within(
    points: DataFrame,
    targets: DataFrame,
    reach: float,
    x: str = "longitude",
    y: str = "latitude",
    target_id: str = "id",
    keep: Sequence[str] = (),
    how: str = "inner",
    crowd: int = 4,
    max_halvings: int = 12,
    max_rows: int = BROADCAST_ROWS,
    list_bound: int = LIST_BOUND,
) -> DataFrame:
    """Attach to each point the nearest target at planar distance <= ``reach``; ties by smallest id.

    Both sides name their coordinates ``x`` and ``y``. Adds ``distance``, ``target_id`` and ``keep``.

    When the targets are measured to be few and nowhere crowded, each grid cell's targets are one broadcast
    row and the points are not shuffled at all. The search looks into the 3x3 cells around a point, first
    with a small cell, then with a doubled one for points that found nothing within that radius, up to
    ``reach``: a hit within the radius is the true nearest, because every target that close lies in the
    searched cells.

    Otherwise points sharing coordinates are searched once. The same search runs level by level, up to the greatest
    radius at which no point looks at more than ``list_bound`` targets, and only with the points still open; lists too
    large to broadcast are joined shuffled. For points that found nothing there the targets become an adaptive cell
    tree (:mod:`tallywing.operators.celltree`).
    """
    payload = [target_id, *keep]
    places = settle(
        targets.filter(is_finite(F.col(x)) & is_finite(F.col(y)))
        .groupBy(F.col(x).alias("_tx"), F.col(y).alias("_ty"))
        .agg(F.min_by(F.struct(*payload), F.col(target_id)).alias("_target"))
    )
    fullest = _fullest_cells(places, reach, max_halvings)
    radii = _search_radii(fullest, reach, crowd)
    fields = ", ".join(f"`{c}`: {targets.schema[c].dataType.simpleString()}" for c in payload)
    unknown = F.lit(None).cast(f"struct<distance: double, {fields}>")
    small = fits_broadcast(places, max_rows // NEIGHBOURS, BROADCAST_BYTES // NEIGHBOURS)
    if small and fullest.get(0, 0) * NEIGHBOURS <= list_bound:
        best = _search_lists(points.withColumn("_best", unknown), places, radii, x, y, payload)
        if how == "inner":
            best = best.filter(F.col("_best").isNotNull())
        return best.select(*points.columns, "_best.*")
    spots = stage(points.select(x, y).filter(is_finite(F.col(x)) & is_finite(F.col(y))).distinct(), "spots")
    bounded = [r for k, r in zip(range(len(radii) - 1, -1, -1), radii) if fullest.get(k, 0) * NEIGHBOURS <= list_bound]
    parts, spots = _search_levels(spots, places, bounded, x, y, payload, small)
    if not parts or bounded[-1] < reach and not spots.isEmpty():
        tree = build_tree(places, lambda t: fits_broadcast(t, max_rows))
        parts.append(search_tree(spots, tree, reach, x, y, payload))
    found = stage(reduce(DataFrame.union, [p.select(x, y, "_best.*") for p in parts]), "nearest")
    return join_lookup(points, found, [x, y], how, max_rows)


def _open_cells(best: DataFrame, radius: float, x: str, y: str) -> DataFrame:
    """The cell of each point still without a target; null for the others."""
    is_open = F.col("_best").isNull() & is_finite(F.col(x)) & is_finite(F.col(y))
    return best.withColumns({
        "_cx": F.when(is_open, _cell(F.col(x), radius)),
        "_cy": F.when(is_open, _cell(F.col(y), radius)),
    })


def _hit(distance: Column, target: Column, payload: Sequence[str]) -> Column:
    return F.struct(distance.alias("distance"), *[target[c].alias(c) for c in payload])


def _nearest_listed(near: Column, radius: float, x: Column, y: Column, payload: Sequence[str]) -> Column:
    hits = F.transform(near, lambda t: _hit(planar_distance(x, y, t["_tx"], t["_ty"]), t["_target"], payload))
    return F.array_min(F.filter(hits, lambda h: h["distance"] <= radius))


def _listed_cells(places: DataFrame, radius: float) -> DataFrame:
    """(``_cx``, ``_cy``, ``_near``): the targets that can be seen from each cell."""
    near = F.collect_list(F.struct("_tx", "_ty", "_target")).alias("_near")
    return _neighbour_cells(places, radius).groupBy("_cx", "_cy").agg(near)


def _search_levels(spots: DataFrame, places: DataFrame, radii: list[float], x: str, y: str, payload: Sequence[str],
                   small: bool) -> tuple[list[DataFrame], DataFrame]:
    """Tables (``x``, ``y``, ``_best``) of the spots that found a target within a radius, and the spots that found none.

    Each level is written once, so the next one starts from its open spots alone. ``small`` tells that a level's lists
    may be broadcast.
    """
    parts: list[DataFrame] = []
    for radius in radii:
        cells = _listed_cells(places, radius)
        cells = cells if small else stage(cells, "cells")
        at = spots.withColumns({"_cx": _cell(F.col(x), radius), "_cy": _cell(F.col(y), radius)})
        near = join_lookup(at, cells, ["_cx", "_cy"], "left", salt_by=[x, y], small=small)
        nearest = _nearest_listed(F.col("_near"), radius, F.col(x), F.col(y), payload)
        seen = stage(near.select(x, y, nearest.alias("_best")), "level")
        parts.append(seen.filter(F.col("_best").isNotNull()))
        spots = seen.filter(F.col("_best").isNull()).select(x, y)
        if spots.isEmpty():
            break
    return parts, spots


def _search_lists(best: DataFrame, places: DataFrame, radii: list[float], x: str, y: str, payload: Sequence[str]) -> DataFrame:
    columns = best.columns
    for radius in radii:
        cells = _listed_cells(places, radius)
        nearest = _nearest_listed(F.col("_near"), radius, F.col(x), F.col(y), payload)
        seen = _open_cells(best, radius, x, y).join(F.broadcast(cells), ["_cx", "_cy"], "left")
        best = seen.withColumn("_best", F.coalesce("_best", nearest)).select(*columns)
    return best
