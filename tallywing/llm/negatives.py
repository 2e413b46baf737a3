"""Hard negatives by exact inner products, several candidates a multiplication.

Components are integers. The components of several candidates are made non-negative and written into separate
fields of one wide integer; one multiplication with an anchor's component then multiplies them all, and the sum over
the components holds each candidate's sum in its field, without carries, because a field is as wide as the largest
sum. Known sums undo the shift into the non-negative. Up to 53 bits the wide integers stand in doubles, which hold
them exactly, so a matrix product does the work; wider fields go to Python's integers with the same result.

Anchors are a set of queries. They are read in blocks of bounded size; every task crosses its candidates with the
block and keeps, per anchor and positive, only the best rows so far. Candidates are never shuffled. Thresholds from
a slice of the candidates keep tasks from sending rows that cannot be among the best; that changes no result.

Defined results: rows with a null label, a null vector, or a null or non-finite component (also after scaling) take
no part; shorter vectors end in zeros; null ids come last among ties and are never anchors unless the condition says
so (the greatest long stands for them inside); rows that repeat are rows, and an anchor is no positive of itself; an
anchor without positives gives no rows; an empty table gives none; other columns are not read. Scores that could
reach 2^55 are an error, as the result's columns could not hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywing.session import scratch_path, stage

#: Anchors of a block, anchors and candidates that are multiplied at once, and the share of candidates that sets thresholds.
ANCHORS, ROWS, COLUMNS, SLICE = 32_768, 256, 4_096, 16
WIDE, EXACT = 256, 53
NO_ID = (1 << 63) - 1
NOTHING = -(1 << 60)


class Fields:
    """Packs candidates' components into fields and unpacks their scores. ``bound`` is the largest absolute component."""

    def __init__(self, size: int, bound: int):
        self.bound = bound
        most = max(1, size) * (2 * bound) ** 2
        self.width = max(1, most.bit_length())
        if most >= 1 << 55:
            raise ValueError("scores of these vectors do not fit the result's columns")
        self.exact = self.width <= EXACT
        self.count = (EXACT if self.exact else WIDE) // self.width
        self.size = size

    def pack(self, candidates: np.ndarray) -> np.ndarray:
        """Wide integers, one row per component and one column per ``count`` candidates."""
        kind = np.float64 if self.exact else object
        shifted = candidates.T + self.bound
        columns = -(-shifted.shape[1] // self.count)
        wide = np.zeros((shifted.shape[0], columns), dtype=kind)
        for k in range(self.count):
            field = shifted[:, k::self.count]
            part = field.astype(kind) if self.exact else field.astype(object)
            wide[:, : field.shape[1]] += part * (1 << k * self.width)
        return wide

    def scores(self, anchors: np.ndarray, wide: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates. ``sums``: each candidate's sum of components."""
        if self.exact:
            product = (anchors + self.bound).astype(np.float64) @ wide
            product = product.astype(np.int64)
        else:
            product = np.dot((anchors + self.bound).astype(object), wide)
        out = np.empty((len(anchors), len(sums)), dtype=np.int64)
        mask = (1 << self.width) - 1
        for k in range(self.count):
            n = len(range(k, len(sums), self.count))
            out[:, k::self.count] = ((product[:, :n] >> k * self.width) & mask).astype(np.int64)
        # (a + b)(c + b) = ac + b(a + c) + bb for every component.
        out -= self.bound * (anchors.sum(axis=1)[:, None] + sums[None, :])
        out -= self.size * self.bound**2
        return out


def best(scores: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``k`` highest scores within its limits, and their columns; earlier columns first among equals."""
    mask = (scores >= least[:, None]) & (scores <= most[:, None]) & other
    if mask.sum() > 4 * k * len(scores) and scores.shape[1] > k:
        floor = np.partition(np.where(mask, scores, NOTHING), -k, axis=1)[:, -k]
        mask &= scores >= floor[:, None]
    row, column = np.nonzero(mask)
    score = scores[row, column]
    order = np.lexsort((column, -score, row))
    row, column, score = row[order], column[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    top, at = np.full((len(scores), k), NOTHING), np.full((len(scores), k), -1)
    top[row[keep], place[keep]], at[row[keep], place[keep]] = score[keep], column[keep]
    return top, at


def _merged(top: np.ndarray, ids: np.ndarray, more: np.ndarray, more_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of two lists per row, by score, then id."""
    score, name = np.concatenate([top, more], axis=1), np.concatenate([ids, more_ids], axis=1)
    order = np.lexsort((name, -score), axis=1)[:, : top.shape[1]]
    return np.take_along_axis(score, order, axis=1), np.take_along_axis(name, order, axis=1)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    flat, ends = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    lengths = np.diff(ends)
    if (lengths == size).all():
        return flat[ends[0] : ends[-1]].reshape(len(lengths), size).astype(np.int64)
    out = np.zeros((len(lengths), size), dtype=np.int64)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        out[i, : b - a] = flat[a:b]
    return out


class Block:
    """Anchors of a block with, per slot, the limits of the scores looked for."""

    def __init__(self, table: pa.Table, size: int, slots: int, same: bool):
        table = table.combine_chunks()
        self.number = table["number"].to_numpy()
        self.label = table["label"].to_numpy()
        self.vectors = _matrix(table["vector"].combine_chunks(), size)
        self.slots, self.same = slots, same
        if same:
            self.least = np.full((len(self.number), 1), NOTHING + 1)
            self.most = np.full((len(self.number), 1), NO_ID)
        else:
            self.least = np.array(table["least"].to_pylist(), dtype=np.int64).reshape(-1, slots)
            self.most = np.array(table["most"].to_pylist(), dtype=np.int64).reshape(-1, slots)


def _search(candidates: DataFrame, block: Block, fields: Fields, k: int, out: str) -> None:
    """Append (``number``, ``slot``, ``score``, ``id``) of each task's best candidates to the table ``out``."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        n, slots = len(block.number), block.slots
        top, ids = np.full((slots, n, k), NOTHING), np.full((slots, n, k), NO_ID)
        for batch in batches:
            names = batch.column("id").fill_null(NO_ID).to_numpy()
            labels, vectors = batch.column("label").to_numpy(zero_copy_only=False), _matrix(batch.column("vector"), fields.size)
            order = np.argsort(names, kind="stable")
            for first in range(0, len(order), COLUMNS):
                part = order[first : first + COLUMNS]
                part_ids, part_labels, sums = names[part], labels[part], vectors[part].sum(axis=1)
                wide = fields.pack(vectors[part])
                for a in range(0, n, ROWS):
                    rows = slice(a, a + ROWS)
                    scores = fields.scores(block.vectors[rows], wide, sums)
                    fits = (block.label[rows, None] == part_labels[None, :]) == block.same
                    for slot in range(slots):
                        # Equal scores may still win by their ids.
                        least = np.maximum(block.least[rows, slot], top[slot, rows, -1])
                        more, at = best(scores, least, block.most[rows, slot], k, fits)
                        if (at[:, 0] >= 0).any():
                            more_ids = np.where(at >= 0, part_ids[at], NO_ID)
                            top[slot, rows], ids[slot, rows] = _merged(top[slot, rows], ids[slot, rows], more, more_ids)
        slot, row, place = np.nonzero(top != NOTHING)
        for a in range(0, len(row), 1 << 16):
            s, r, p = slot[a : a + (1 << 16)], row[a : a + (1 << 16)], place[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.number[r]), pa.array(s.astype(np.int32)), pa.array(top[s, r, p]), pa.array(ids[s, r, p])],
                names=["number", "slot", "score", "id"])

    candidates.mapInArrow(run, "number long, slot int, score long, id long").write.mode("append").parquet(out)
    shared.unpersist()


def _floors(found: DataFrame, k: int) -> DataFrame:
    """The ``k``-th best score found per anchor and slot: no row below it can be among the best."""
    by_score = Window.partitionBy("number", "slot").orderBy(F.desc("score"))
    return found.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == k).select("number", "slot", F.col("score").alias("floor"))


def _divided(whole: Column, by: int) -> Column:
    """The quotient of whole numbers, rounded down."""
    return F.call_function("div", whole - F.pmod(whole, F.lit(by)), F.lit(by))


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """Columns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``anchor`` tells query rows. A negative has another label and a score from ``least`` to ``most`` percent of the
    positive's; a component ``x`` counts as ``floor(scale * x)``.
    """
    spark = rows.sparkSession
    scaled = F.transform(vector_col, lambda x: x.cast("double") * F.lit(float(scale)))
    whole = F.forall("scaled", lambda x: F.coalesce((F.abs(x) < float(1 << 62)) & ~F.isnan(x), F.lit(False)))
    kept = (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), scaled.alias("scaled"),
                    F.coalesce(anchor, F.lit(False)).alias("asks"))
        .filter(F.col("label").isNotNull() & F.col("scaled").isNotNull()).filter(whole)
        .select("id", "label", "asks", F.transform("scaled", lambda x: F.floor(x)).alias("vector")))
    every = stage(kept, "vectors")
    largest = F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))
    size, bound, asked = every.agg(F.max(F.size("vector")), F.max(largest), F.count_if("asks")).first()
    fields = Fields(size or 0, bound or 0)
    blocks = max(1, -(-asked // ANCHORS))
    queries = stage(
        every.filter("asks").withColumn("number", F.monotonically_increasing_id())
        .withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks))), "anchors")
    candidates = every.select("id", "label", "vector")

    near = scratch_path(spark, "near")
    for i in range(blocks):
        table = queries.filter(F.col("block") == i).select("number", "label", "vector").toArrow()
        _search(candidates, Block(table, fields.size, 1, True), fields, positives + 1, near)
    by_score = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    found = spark.read.parquet(near).withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives + 1)
    # One row of the anchor's id and its own score is the anchor itself; rows that agree in both are alike.
    own = queries.select("number", F.col("id").alias("anchor_id"),
                         F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("own"))
    itself = (F.coalesce("anchor_id", F.lit(NO_ID)) == F.col("id")) & (F.col("score") == F.col("own"))
    mine_ = F.min(F.when(itself, F.col("place"))).over(Window.partitionBy("number"))
    pairs = (
        found.join(own, "number").withColumn("mine", F.coalesce(mine_, F.lit(positives + 1))).filter("place != mine")
        .withColumn("slot", F.when(F.col("place") < F.col("mine"), F.col("place") - 1).otherwise(F.col("place") - 2).cast("int"))
        .select("number", "slot", "anchor_id", F.when(F.col("id") != NO_ID, F.col("id")).alias("positive_id"), F.col("score").alias("positive_score")))
    pairs = stage(pairs, "positives")

    # 30 p <= 100 n <= 90 p in whole numbers.
    least_of, most_of = -_divided(-least * F.col("positive_score"), 100), _divided(most * F.col("positive_score"), 100)
    looked = pairs.select("number", "slot", least_of.alias("least"), most_of.alias("most"))

    def limited(i: int, limits: DataFrame) -> Block:
        """The block's anchors with limits for each of their positives; a slot without one looks for nothing."""
        per_anchor = limits.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("least", "most")))).alias("by_slot"))
        slots = F.sequence(F.lit(0), F.lit(positives - 1))
        sides = [F.transform(slots, lambda s: F.coalesce(F.try_element_at("by_slot", s)[side], F.lit(missing))).alias(side)
                 for side, missing in (("least", NO_ID), ("most", NOTHING))]
        block = queries.filter(F.col("block") == i).join(per_anchor, "number").select("number", "label", "vector", *sides)
        return Block(block.toArrow(), fields.size, positives, False)

    sample, far = scratch_path(spark, "sample"), scratch_path(spark, "far")
    for i in range(blocks):
        _search(candidates.filter(F.pmod(F.xxhash64("id"), F.lit(SLICE)) == 0), limited(i, looked), fields, negatives, sample)
    floors = stage(_floors(spark.read.parquet(sample), negatives), "floors")
    raised = looked.join(floors, ["number", "slot"], "left").select(
        "number", "slot", F.greatest("least", F.coalesce("floor", "least")).alias("least"), "most")
    for i in range(blocks):
        _search(candidates, limited(i, raised), fields, negatives, far)
    by_pair = Window.partitionBy("number", "slot").orderBy(F.desc("score"), "id")
    hard = spark.read.parquet(far).withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= negatives)
    return hard.join(pairs, ["number", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
