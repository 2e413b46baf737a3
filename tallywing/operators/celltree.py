"""Nearest search in an adaptive cell tree, for targets of any number and crowding.

The targets' square is cut into 8 x 8 cells, and a cell is cut again only while it holds more than ``LEAF`` targets. The
tree is a table: one row per cut cell with its cells that are not empty, each with the box around its targets, and one
row per leaf with its few targets. Every level is found by counts that add up before the shuffle.

A point first goes down to the leaf whose box is nearest at every level; the nearest target there bounds the search.
Then it goes down to all leaves whose box is no farther than that bound: the true nearest target lies in one of them.
Points are far fewer than pairs at every step: a point meets at most 64 boxes per cut cell, as one array, and only
the leaves that can still win become rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.functions.geo import planar_distance
from tallywing.operators.skew import salted_join
from tallywing.session import settle, stage

LEAF = 32
#: Bits of a cell number that a level adds, and levels; 51 bits tell coordinates apart as doubles do.
BITS, LEVELS = 3, 17


@dataclass
class CellTree:
    """``nodes`` (``lvl_``, ``cx_``, ``cy_``, ``cells_``) and ``leaves`` (``lvl_``, ``cx_``, ``cy_``, ``near_``).

    ``small`` tells whether both were measured to fit a broadcast.
    """

    nodes: DataFrame
    leaves: DataFrame
    depth: int
    small: bool


def build_tree(places: DataFrame, fits, leaf: int = LEAF) -> CellTree:
    """The tree of ``places`` (``_tx``, ``_ty``, ``_target``), at most one row per pair of coordinates.

    ``fits`` measures whether a table may be broadcast.
    """
    left, right, low, high = places.agg(F.min("_tx"), F.max("_tx"), F.min("_ty"), F.max("_ty")).first()
    if left is None:
        left = right = low = high = 0.0
    # Halved, as the difference of two great coordinates may not be finite.
    extent = max(right / 2 - left / 2, high / 2 - low / 2) or 1.0
    top = (1 << BITS * LEVELS) - 1

    def number(value: str, first: float) -> Column:
        share = (F.col(value) / 2 - F.lit(first / 2)) / F.lit(extent)
        return F.least(F.floor(share * F.lit(float(top + 1))), F.lit(top))

    open_ = places.select("_tx", "_ty", "_target", number("_tx", left).alias("nx_"), number("_ty", low).alias("ny_"))
    nodes, leaves, level = [], [], 0
    while True:
        level += 1
        shift = BITS * (LEVELS - level)
        at = open_.withColumns({"cx_": F.shiftright("nx_", shift), "cy_": F.shiftright("ny_", shift)})
        boxes = settle(at.groupBy("cx_", "cy_").agg(
            F.count("*").alias("n_"), F.min("_tx").alias("left"), F.max("_tx").alias("right"), F.min("_ty").alias("low"), F.max("_ty").alias("high")))
        crowded = (F.col("n_") > leaf) if level < LEVELS else F.lit(False)
        cells = F.struct(F.col("cx_").alias("cx"), F.col("cy_").alias("cy"), "left", "right", "low", "high", crowded.alias("cut"))
        nodes.append(
            boxes.groupBy(F.shiftright("cx_", BITS).alias("cx_"), F.shiftright("cy_", BITS).alias("cy_"))
            .agg(F.collect_list(cells).alias("cells_")).select(F.lit(level - 1).alias("lvl_"), "cx_", "cy_", "cells_"))
        cut = boxes.filter(crowded).select("cx_", "cy_", F.lit(True).alias("cut_"))
        small = fits(cut)
        marked = at.join(F.broadcast(cut), ["cx_", "cy_"], "left") if small else salted_join(at, cut, ["cx_", "cy_"], "left")
        marked = stage(marked, "cells")
        leaves.append(
            marked.filter("cut_ is null").groupBy("cx_", "cy_").agg(F.collect_list(F.struct("_tx", "_ty", "_target")).alias("near_"))
            .select(F.lit(level).alias("lvl_"), "cx_", "cy_", "near_"))
        if boxes.filter(crowded).isEmpty():
            break
        open_ = marked.filter("cut_").select("_tx", "_ty", "_target", "nx_", "ny_")
    tables = []
    for parts in (nodes, leaves):
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        tables.append(stage(out, "tree"))
    return CellTree(*tables, depth=level, small=all(fits(t) for t in tables))


def _box_distance(x: Column, y: Column, cell: Column) -> Column:
    """From a point to a box; no target in the box is nearer, also after rounding."""
    return planar_distance(x, y, F.greatest(F.least(x, cell["right"]), cell["left"]), F.greatest(F.least(y, cell["high"]), cell["low"]))


def _joined(rows: DataFrame, table: DataFrame, tree: CellTree, keys: Sequence[str], x: str, y: str) -> DataFrame:
    if tree.small:
        return rows.join(F.broadcast(table), list(keys), "inner")
    return salted_join(rows, table, keys, "inner", salt_by=[x, y])


def _hits(rows: DataFrame, tree: CellTree, x: str, y: str, payload: Sequence[str]) -> DataFrame:
    """(``x``, ``y``, ``hit_``): the nearest target of each row's leaf."""
    near = _joined(rows, tree.leaves, tree, ["lvl_", "cx_", "cy_"], x, y)
    hits = F.transform("near_", lambda t: F.struct(
        planar_distance(F.col(x), F.col(y), t["_tx"], t["_ty"]).alias("distance"), *[t["_target"][c].alias(c) for c in payload]))
    return near.withColumn("hit_", F.array_min(hits))


def _down(rows: DataFrame, tree: CellTree, level: int, x: str, y: str, choose) -> DataFrame:
    """Rows of one level with ``next_``: the cells that ``choose`` takes of the cut cell's cells with their distances."""
    nodes = tree.nodes.filter(F.col("lvl_") == level).drop("lvl_")
    seen = _joined(rows, nodes, tree, ["cx_", "cy_"], x, y)
    cells = F.transform("cells_", lambda c: F.struct(_box_distance(F.col(x), F.col(y), c).alias("far"), c["cx"].alias("cx"),
                                                     c["cy"].alias("cy"), c["cut"].alias("cut")))
    return seen.withColumn("next_", choose(cells)).drop("cells_", "cx_", "cy_")


def candidate_leaves(spots: DataFrame, tree: CellTree, reach: float, x: str, y: str, payload: Sequence[str]) -> DataFrame:
    """(``x``, ``y``, ``lvl_``, ``cx_``, ``cy_``): the leaves that may hold a spot's nearest target within ``reach``."""
    here = spots.select(x, y)
    root = here.withColumns({"cx_": F.lit(0).cast("long"), "cy_": F.lit(0).cast("long")})
    path, ended = root, []
    for level in range(tree.depth):
        step = _down(path, tree, level, x, y, F.array_min).select(x, y, F.col("next_.cx").alias("cx_"), F.col("next_.cy").alias("cy_"), "next_.cut")
        ended.append(step.filter("not cut").select(x, y, F.lit(level + 1).alias("lvl_"), "cx_", "cy_"))
        path = step.filter("cut").drop("cut")
    first = ended[0]
    for more in ended[1:]:
        first = first.unionByName(more)
    bound = F.least(F.col("hit_.distance"), F.lit(float(reach)))
    rows = settle(_hits(first, tree, x, y, payload).select(x, y, bound.alias("bound_")))
    rows = rows.withColumns({"cx_": F.lit(0).cast("long"), "cy_": F.lit(0).cast("long")})
    found = []
    for level in range(tree.depth):
        step = _down(rows, tree, level, x, y, lambda cells: F.filter(cells, lambda c: c["far"] <= F.col("bound_")))
        step = step.withColumn("cell_", F.explode("next_")).select(x, y, "bound_", F.col("cell_.cx").alias("cx_"), F.col("cell_.cy").alias("cy_"), "cell_.cut")
        found.append(step.filter("not cut").select(x, y, F.lit(level + 1).alias("lvl_"), "cx_", "cy_"))
        rows = step.filter("cut").drop("cut")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def search_tree(spots: DataFrame, tree: CellTree, reach: float, x: str, y: str, payload: Sequence[str]) -> DataFrame:
    """(``x``, ``y``, ``_best``): the nearest target of each spot within ``reach``, ties by the payload's order."""
    leaves = stage(candidate_leaves(spots, tree, reach, x, y, payload), "leaves")
    hits = _hits(leaves, tree, x, y, payload).filter(F.col("hit_.distance") <= F.lit(float(reach)))
    return hits.groupBy(x, y).agg(F.min("hit_").alias("_best"))
