"""Hard negatives against brute force in Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywing.llm import negatives


def brute(rows, asks, positives=5, count=10):
    kept = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = max((len(v) for _, v, _ in kept), default=0)
    kept = [(i, v + [0] * (size - len(v)), c) for i, v, c in kept]
    last = (1 << 63) - 1
    out = []
    for a, (name, vector, label) in enumerate(kept):
        if not asks(name):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), last if i is None else i, c) for b, (i, v, c) in enumerate(kept) if b != a)
        near = [(-s, i) for s, i, c in scored if c == label][:positives]
        for score, found in near:
            fit = [(-s, i) for s, i, c in scored if c != label and 30 * score <= -100 * s <= 90 * score][:count]
            out += [(name, found, r + 1, i, score, s) for r, (s, i) in enumerate(fit)]
    return sorted(tuple(-1 if x in (None, last) else x for x in o) for o in out)


def made(rng, n, values, labels=3):
    rows = []
    for i in range(n):
        vector = [rng.choice(values) for _ in range(6)]
        rows.append((i if rng.random() > 0.05 else rng.choice([None, 7, 100]), vector, rng.choice([None, *range(labels)])))
    return rows + [(1, None, 0), (2, [0.5, None], 0), (3, [float("nan")], 1), (4, [float("inf")] * 6, 1), (5, [0.5, 0.5], 1), (6, [], 0), (100, [0.9] * 6, 1)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "1 as id", "2 as number", "'x' as scaled", "3 as slot")


def found(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


@pytest.mark.parametrize("values", [[0.0, 0.5, -0.25], [i / 97 for i in range(-60, 97)], [-3.0, 20.0, 900.5]])
def test_mine_as_brute_force(spark, values):
    rows = made(random.Random(len(values)), 150, values)
    df = negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert found(df) == brute(rows, lambda i: i is not None and i % 10 == 0)


def test_blocks_change_nothing(spark, monkeypatch):
    for name, value in (("ANCHORS", 4), ("ROWS", 3), ("COLUMNS", 7), ("SLICE", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = made(random.Random(2), 120, [0.0, 0.5, 0.5, 1.0, -0.25])
    df = negatives.mine(frame(spark, rows).repartition(5), F.col("vec_id") % 10 == 0)
    assert found(df) == brute(rows, lambda i: i is not None and i % 10 == 0)


@pytest.mark.parametrize("size,bound", [(1, 1), (64, 159), (64, 5000), (700, 255), (3, 1 << 24), (5, 0)])
def test_fields_are_exact(size, bound):
    rng = np.random.default_rng(1)
    a, c = rng.integers(-bound, bound + 1, (9, size)), rng.integers(-bound, bound + 1, (23, size))
    a[0], c[0], c[1] = bound, bound, -bound
    fields = negatives.Fields(size, bound)
    assert fields.count * fields.width <= (53 if fields.exact else 256)
    got = fields.scores(a, fields.pack(c), c.sum(axis=1))
    assert got.tolist() == (a.astype(object) @ c.T.astype(object)).tolist()


def test_several_candidates_share_a_number():
    assert negatives.Fields(64, 159).count == 2 and negatives.Fields(8, 20).count >= 3
    wide = negatives.Fields(3, 1 << 25)
    assert not wide.exact and wide.count >= 4


def test_too_large_scores_are_an_error():
    with pytest.raises(ValueError):
        negatives.Fields(64, 1 << 40)


def test_empty(spark):
    empty = frame(spark, made(random.Random(1), 3, [0.5])).limit(0)
    assert negatives.mine(empty, F.col("vec_id") % 10 == 0).count() == 0
    no_anchor = frame(spark, [(1, [0.5], 0), (2, [0.5], 0)])
    assert negatives.mine(no_anchor, F.col("vec_id") % 10 == 0).count() == 0
