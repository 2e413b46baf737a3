"""Skewed and crowded inputs: same rows as the plain form, by plans that do not gather them."""

import math
import random
import statistics

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywing.operators import celltree, cleaning, distinct, joins, selection, skew, stats
from tallywing.operators.hooks import aggregate_with


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Exact order statistics


@pytest.mark.parametrize("few", [1, 5, 10_000])
def test_order_statistics_at_every_position(table, few):
    rng = random.Random(few)
    values = [0.0, -0.0, 1e-320, 5e-324, -1e308, 1e308, float("inf"), float("-inf"), float("nan"), 1.0, 1.0, 1.0]
    values += [rng.uniform(1, 1.0001) for _ in range(40)] + [math.exp(rng.uniform(-600, 600)) * rng.choice([1, -1]) for _ in range(40)]
    data = table([("a", v) for v in values] + [("a", None), ("b", 2.0)], "g_ string, v_ double").repartition(3)
    wanted = table([("a", i, i) for i in range(1, len(values) + 1)] + [("b", 1, 1)], "g_ string, at_ int, rank_ long")
    got = {(r.g_, r.at_): r.value_ for r in selection.order_statistics(data, wanted, few=few).collect()}
    in_order = sorted(values, key=lambda v: (math.isnan(v), 0 if math.isnan(v) else v))
    assert len(got) == len(values) + 1 and got["b", 1] == 2.0
    for i, v in enumerate(in_order, 1):
        assert got["a", i] == v or math.isnan(v) and math.isnan(got["a", i])


def test_codes_grow_with_values(table):
    rng = random.Random(2)
    values = sorted([rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(2000)] + [0.0, 5e-324, float("inf"), float("-inf")])
    codes = [r.c for r in table([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", selection.code(F.col("v")).alias("c")).orderBy("i").collect()]
    assert codes == sorted(codes)


def test_median_of_a_hot_group(table):
    """One group with nine tenths of the rows: its reducer gets counts of codes, no rows."""
    rng = random.Random(4)
    hot = [rng.gauss(50, 10) for _ in range(45_000)]
    rest = [("g%d" % (i % 50), float(i)) for i in range(5000)]
    df = table([("hot", v) for v in hot] + rest, "g string, v double").repartition(5)
    got = {r.g: r for r in stats.summarize(df, "g", "v").collect()}
    assert got["hot"].median == statistics.median(hot) and got["hot"]["count"] == 45_000
    assert got["g7"].median == statistics.median([v for g, v in rest if g == "g7"])
    tally = selection.code_counts(df.select(F.col("g").alias("g_"), F.col("v").alias("v_")))
    assert tally.filter("g_ = 'hot'").count() < 1000
    assert plan(tally).index("HashAggregate") < plan(tally).index("Exchange") and "percentile" not in plan(stats.summarize(df, "g", "v"))


# Skewed lookups


@pytest.fixture
def skewed(table):
    rows = [("hot", i % 7, "x") for i in range(6000)] + [(f"k{i % 900}", i, "y") for i in range(2000)] + [(None, i % 3, "z") for i in range(3000)]
    return table(rows, "k string, v int, salt_ string").repartition(6)


def test_only_hot_keys_are_salted(spark, skewed):
    hot = skew.heavy_hitters(skewed, ["k"])
    assert list(hot) == ["3:hot"] and 3 <= hot["3:hot"] <= 4  # three quarters of the known keys, four partitions


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skewed_join_gives_the_same_rows(table, rows, skewed, how):
    lookup = table([("hot", "H", 1), ("hot", "I", 2), (None, "N", 3)] + [(f"k{i}", f"n{i}", i) for i in range(0, 900, 2)], "k string, name string, v2 int")
    wide = joins.join_lookup(skewed, lookup, "k", how, small=False)
    assert rows(wide) == rows(joins.join_lookup(skewed, lookup, "k", how, small=True))
    assert wide.columns == ["k", "v", "salt_", "name", "v2"]


def test_null_keys_are_not_shuffled(table, skewed):
    lookup = table([("hot", "H")], "k string, name string")
    text = plan(joins.join_lookup(skewed, lookup, "k", "left", small=False))
    union, other = text.index("Union"), text.rindex("isnull(k")
    assert "SortMergeJoin" in text[union:] or "ShuffledHashJoin" in text[union:]
    # Below the union's branch of null keys there is no exchange by key.
    assert "hashpartitioning(k" not in text[text.rindex("Project", 0, other):]


def test_two_key_columns_and_tricky_texts(table, rows):
    facts = table([("a", "b:c"), ("a:b", "c"), ("", "x"), (None, "x"), ("1:a", None)] * 40, "p string, q string")
    lookup = table([("a", "b:c", 1), ("a:b", "c", 2), ("", "x", 3), (None, "x", 4)], "p string, q string, n int")
    for how in ("left", "inner"):
        assert rows(joins.join_lookup(facts, lookup, ["p", "q"], how, small=False)) == rows(joins.join_lookup(facts, lookup, ["p", "q"], how, small=True))


# Nearest search among crowded targets


def test_crowded_corner_is_searched_with_few_candidates(spark, table):
    """100,000 targets in one corner: every point looks at a bounded number of them, however large the crowd."""
    corner = spark.range(100_000).selectExpr(
        "id", "(id * 7919 % 99991) / 99991D * 0.5 as longitude", "(id * 104729 % 99989) / 99989D * 0.5 as latitude")
    far = spark.range(30).selectExpr("id + 200000 as id", "cast(id * 11 % 60 as double) - 30 as longitude", "cast(id * 17 % 60 as double) - 30 as latitude")
    targets = corner.union(far)
    rng = random.Random(9)
    spots = [(rng.uniform(0, 0.5), rng.uniform(0, 0.5)) for _ in range(60)] + [(rng.uniform(-30, 30), rng.uniform(-30, 30)) for _ in range(60)]
    points = table([(i, x, y) for i, (x, y) in enumerate(spots)], "p int, longitude double, latitude double")
    near = joins.nearest_within(points, targets, 40.0, how="left", list_bound=0)
    got = {r.p: (r.distance, r.id) for r in near.collect()}
    known = [(r.longitude, r.latitude, r.id) for r in targets.collect()]
    frame = pd.DataFrame(known, columns=["x", "y", "id"])
    for i, (x, y) in enumerate(spots):
        d = ((frame.x - x) * (frame.x - x) + (frame.y - y) * (frame.y - y)) ** 0.5
        assert got[i][0] == pytest.approx(d.min(), abs=1e-12)
    places = targets.select(F.col("longitude").alias("_tx"), F.col("latitude").alias("_ty"), F.struct("id").alias("_target"))
    tree = celltree.build_tree(places.dropDuplicates(["_tx", "_ty"]), joins.fits_broadcast)
    assert tree.depth > 2 and tree.leaves.agg(F.max(F.size("near_"))).first()[0] <= celltree.LEAF
    leaves = celltree.candidate_leaves(points, tree, 40.0, "longitude", "latitude", ["id"])
    seen = leaves.join(tree.leaves, ["lvl_", "cx_", "cy_"]).groupBy("longitude", "latitude").agg(F.sum(F.size("near_")).alias("n"))
    worst, mean = seen.agg(F.max("n"), F.avg("n")).first()
    assert worst <= 60 * celltree.LEAF and mean <= 10 * celltree.LEAF


def test_tree_beyond_the_broadcast_bound(table, monkeypatch):
    rng = random.Random(1)
    targets = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(400)] + [(900, 5.0, 5.0), (800, 5.0, 5.0), (700, None, 0.0), (701, float("nan"), 0.0)]
    points = [(i, rng.gauss(0, 3), rng.gauss(0, 3)) for i in range(150)] + [(500, 1.0, 1.0)] * 40 + [(600, 5.0, 5.0), (601, None, 1.0)]
    schema = "longitude double, latitude double"
    monkeypatch.setattr(celltree, "LEAF", 8)
    near = joins.nearest_within(table(points, f"p int, {schema}"), table(targets, f"id int, {schema}"), 1.5, how="left", max_rows=0)
    got = {r.p: r.id for r in near.collect()}
    for p, x, y in points:
        best = min(((math.sqrt((x - tx) ** 2 + (y - ty) ** 2), i) for i, tx, ty in targets if x is not None and tx is not None and tx == tx), default=(9, None))
        assert got[p] == (best[1] if best[0] <= 1.5 else None)
    assert got[600] == 800 and near.count() == len(points)


# Distinct counts over spans


def test_sketches_of_days_against_exact_counts(spark):
    rows = spark.range(60_000).selectExpr("id * 7919 % 40000 as user", "date_add(date'2024-01-01', cast(id % 20 as int)) as day", "id % 3 as g")
    spans = spark.sql("select * from values (date'2024-01-01', date'2024-01-20'), (date'2024-01-05', date'2024-01-07'), (date'2023-12-01', date'2024-01-01'),"
                      " (date'2024-01-09', date'2024-01-02'), (date'2025-01-01', date'2025-01-02') s(first_day, last_day)")
    sketches = distinct.daily_sketches(rows, "day", "user", "g")
    exact = {tuple(r)[:3]: r["values"] for r in distinct.exact_over(rows, spans, "day", "user", "g").collect()}
    near = {tuple(r)[:3]: r["values"] for r in distinct.distinct_over(sketches, spans, "g").collect()}
    assert set(exact) == set(near) and len(exact) == 9
    bound = 3 * 2 ** (-distinct.ACCURACY / 2)
    assert all(abs(near[k] - n) <= n * bound for k, n in exact.items())
    assert all(near[k] == n for k, n in exact.items() if n < 2 ** distinct.ACCURACY)


# A user's own aggregation


def test_aggregation_hook(spark, monkeypatch):
    def fold(state, frame):
        n, total = state or (0, 0)
        return n + len(frame), total + int(frame["v"].sum())

    def merge(a, b):
        return a[0] + b[0], a[1] + b[1]

    def finish(state):
        return pd.DataFrame({"n": [state[0]], "total": [state[1]]})

    big = 1 << 60
    df = spark.range(5000, numPartitions=7).selectExpr(f"case when id % 11 = 0 then null else {big} + id % 5 end as k", "id % 100 as v", "1 as state", "2 as share")
    got = {r.k: (r.n, r.total) for r in aggregate_with(df, "k", ["v"], fold, merge, finish, "n long, total long").collect()}
    want = {r.k: (r.n, r.total) for r in df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total")).collect()}
    assert got == want
    assert aggregate_with(df.limit(0), "k", ["v"], fold, merge, finish, "n long, total long").count() == 0


# Column names of the user


def test_inner_names_do_not_meet_the_users_columns(table, rows):
    df = table([(1, "a", "x", "m"), (1, "b", None, "n"), (2, "c", "y", "o")], "k int, place_ string, v string, mode_ string")
    assert rows(cleaning.dedup(df, ["k"])) == [(1, "a", "x", "m"), (2, "c", "y", "o")]
    assert rows(cleaning.fill_group_mode(df, "k", "v")) == [(1, "a", "x", "m"), (1, "b", "x", "n"), (2, "c", "y", "o")]


def test_crowded_targets_leave_the_tree_to_far_points(table, monkeypatch):
    """Where the reach sees too many targets, smaller radii settle the points near them; only the others go down a tree."""
    rng = random.Random(5)
    targets = [(i, rng.uniform(0, 4), rng.uniform(0, 4)) for i in range(600)] + [(900, 1.0, 1.0), (800, 1.0, 1.0), (901, None, 0.0)]
    points = [(i, rng.uniform(0, 4), rng.uniform(0, 4)) for i in range(150)] + [(300, 1.0, 1.0), (301, 1.0, 1.0), (302, None, 1.0), (303, float("nan"), 1.0)]
    far = [(400 + i, rng.uniform(-30, 0), rng.uniform(-30, 0)) for i in range(20)]
    schema, searched = "longitude double, latitude double", []
    search = joins.search_tree
    monkeypatch.setattr(joins, "search_tree", lambda spots, *a: searched.append(spots.count()) or search(spots, *a))

    def check(points, max_rows):
        near = joins.nearest_within(table(points, f"p int, {schema}"), table(targets, f"id int, {schema}"), 20.0, how="left", max_rows=max_rows)
        got = {r.p: (r.distance, r.id) for r in near.collect()}
        assert len(got) == len(points)
        for p, x, y in points:
            best = min(((math.sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)), i) for i, tx, ty in targets
                        if x is not None and tx is not None), default=(99, None))
            assert got[p] == (best if best[0] <= 20.0 else (None, None))

    for max_rows in (joins.BROADCAST_ROWS, 0):
        check(points, max_rows)
        assert not searched
        check(points + far, max_rows)
        assert 0 < searched.pop() <= len(far)
