import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallywing.operators import cleaning, filters, joins, ranking, stats


def test_reason_choice(table, rows):
    df = table(
        [("A", "Late", "Unknown"), ("A", "Unknown", "Lost"), ("A", "Unknown", "NULL"), ("A", "", "Lost"),
         ("A", "NULL", "Lost"), ("A", "Unknown", "Unknown"), ("NULL", "Late", "Lost"), ("", "Late", "Lost"),
         (None, "Late", "Lost"), (" B ", " Rude ", None), ("B", None, "Lost")],
        "airline string, r1 string, r2 string",
    )
    assert rows(filters.with_reason(df, "airline", "r1", "r2"), "airline", "reason") == [
        ("A", "Late"), ("A", "Lost"), ("B", "Rude")
    ]
    widened = filters.with_reason(df, "airline", "r1", "r2", fallback_markers=("Unknown", "NULL", ""))
    assert rows(widened, "airline", "reason") == [
        ("A", "Late"), ("A", "Lost"), ("A", "Lost"), ("A", "Lost"), ("B", "Lost"), ("B", "Rude")
    ]


def ties(table):
    counts = {"a": 3, "b": 3, "c": 2, "d": 1}
    return table([("g", v) for v, n in counts.items() for _ in range(n)], "g string, v string")


def test_top_per_group_tie_rules(table, rows):
    df = ties(table)
    assert rows(ranking.top_per_group(df, "g", "v", 5, one_per_count=True), "rank", "v", "n") == [
        (1, "b", 3), (2, "c", 2), (3, "d", 1)
    ]
    assert rows(ranking.top_per_group(df, "g", "v", 3), "rank", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert ranking.top_lists(df, "g", "v", 3).first()["top_values"] == ["a", "b", "c"]


def test_top_n_all_none_some(table):
    df = ties(table)
    assert [r["v"] for r in ranking.top_n(df, "v", 2).collect()] == ["a", "b"]
    assert [r["v"] for r in ranking.top_n(df, "v", -1).collect()] == ["a", "b", "c", "d"]
    assert ranking.top_n(df, "v", 0).count() == 0
    with pytest.raises(ValueError):
        ranking.top_n(df, "v", -2)


def test_group_mode_fill(table, rows):
    df = table([("A", "x"), ("A", "x"), ("A", "y"), ("A", None), ("B", None), (None, None), (None, "z")], "g string, v string")
    assert rows(cleaning.fill_group_mode(df, "g", "v")) == sorted(
        [(None, "Unknown"), (None, "z"), ("A", "x"), ("A", "x"), ("A", "x"), ("A", "y"), ("B", "Unknown")],
        key=lambda t: (t[0] is not None, t),
    )


def test_mean_and_global_mode_fill(table, rows):
    df = table([(1, "a"), (3, None), (None, "a")], "n int, s string")
    assert rows(cleaning.fill_mean(df, "n"), "n") == [(1.0,), (2.0,), (3.0,)]
    assert rows(cleaning.fill_global_mode(df, "s"), "s") == [("a",)] * 3
    empty = table([(None, None)], "n int, s string")
    assert rows(cleaning.fill_mean(empty, "n"), "n") == [(None,)]
    assert rows(cleaning.fill_global_mode(empty, "s"), "s") == [(None,)]


def test_dedup_keeps_the_first_in_order(table, rows):
    df = table([(1, "x", 5), (1, "x", 3), (1, "x", 3), (2, None, 9), (2, None, 8)], "k int, t string, v int")
    assert rows(cleaning.dedup(df, ["k", "t"])) == [(1, "x", 3), (2, None, 8)]
    assert tuple(cleaning.dedup_counts(df, ["k", "t"]).first()) == (5, 2)


def test_require_columns_ignores_case(table):
    df = table([(1,)], "Abc int")
    assert cleaning.require_columns(df, ["aBC"]) is df
    with pytest.raises(ValueError, match="missing"):
        cleaning.require_columns(df, ["missing"])


def test_union_by_name_fills_absent_columns(table, rows):
    a, b = table([(1, "x")], "i int, s string"), table([("y", 2.5, 2)], "s string, d double, i int")
    assert rows(cleaning.union_tables(a, b), "i", "s", "d") == [(1, "x", None), (2, "y", 2.5)]


def test_null_profile_and_missing(table, rows):
    df = table([(None, "NULL"), (1, None), (2, "x")], "a int, b string")
    assert rows(stats.null_profile(df)) == [("a", 1), ("b", 1)]
    assert df.agg(stats.missing_count(F.col("b"))).first()[0] == 2
    assert rows(stats.value_counts(df, "b")) == [("NULL", 1), ("x", 1)]
    assert tuple(stats.nonfinite_check(table([(float("nan"),), (None,)], "v double"), "v").first()) == (True, False)


def test_share_and_ratio(table, rows):
    df = table([("a",), ("a",), ("a",), ("b",)], "k string")
    assert rows(stats.share_of_total(df, "k")) == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert stats.distinct_ratio(df, "k").first()["ratio"] == 0.5


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 10, 1001, 30_000])
def test_exact_medians(table, size):
    rng = random.Random(size)
    groups = {
        "wide": [rng.uniform(-1e9, 1e9) for _ in range(size)],
        "same": [7.5] * size,
        "few": [float(rng.choice([1, 1, 1, 2, 50])) for _ in range(size)],
        "steep": [math.exp(rng.uniform(-300, 300)) for _ in range(size)],
        None: [float(rng.randint(0, 10)) for _ in range(size)],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("none", None), ("wide", None)]
    rng.shuffle(data)
    got = {r["g"]: r for r in stats.summarize(table(data, "g string, v double").repartition(7), "g", "v").collect()}
    for g, values in groups.items():
        assert got[g]["median"] == statistics.median(values), g
        assert (got[g]["count"], got[g]["min"], got[g]["max"]) == (size, min(values), max(values))
    assert got["none"]["median"] is None and got["none"]["count"] == 0


def test_medians_with_more_groups_than_fit_a_broadcast(table, monkeypatch):
    data = [("hot", float(i)) for i in range(3001)] + [(f"g{i}", float(i + j)) for i in range(40) for j in range(4)]
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    got = {r["g"]: r["median"] for r in stats.summarize(table(data, "g string, v double"), "g", "v").collect()}
    assert got == {"hot": 1500.0, **{f"g{i}": i + 1.5 for i in range(40)}}


def test_lookup_join_is_the_same_shuffled_and_broadcast(table, rows):
    # One key holds two thirds of the rows, among them equal rows; null keys match nothing.
    facts = table([("hot", i % 5) for i in range(200)] + [(f"k{i}", i) for i in range(90)] + [(None, 1)] * 10, "k string, v int")
    lookup = table([("hot", "H"), ("k3", "T"), ("k3", "U"), (None, "N")], "k string, name string")
    for how in ("left", "inner"):
        small = joins.join_lookup(facts, lookup, "k", how)
        large = joins.join_lookup(facts, lookup, "k", how, max_rows=0)
        assert rows(small) == rows(large)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    assert not joins.fits_broadcast(lookup, max_rows=3)
    assert not joins.fits_broadcast(lookup, max_bytes=10)
    assert joins.fits_broadcast(lookup)


def brute_nearest(points, targets, reach):
    out = {}
    for key, x, y in points:
        if x is None or y is None or not (math.isfinite(x) and math.isfinite(y)):
            continue
        best = min(
            ((math.sqrt((x - tx) * (x - tx) + (y - ty) * (y - ty)), i) for i, tx, ty in targets), default=(math.inf, 0)
        )
        if best[0] <= reach:
            out[key] = best[1]
    return out


@pytest.mark.parametrize("limits", [{}, {"list_bound": 0}, {"max_rows": 0}])
def test_nearest_matches_brute_force(table, limits):
    rng = random.Random(5)
    # A third of the points share one spot; targets crowd into one corner, with equal spots.
    points = [(i, 1.0, 1.0) for i in range(60)] + [(100 + i, rng.uniform(-40, 40), rng.uniform(-40, 40)) for i in range(100)]
    points += [(900, None, 1.0), (901, float("nan"), 1.0), (902, float("inf"), 0.0)]
    targets = [(i, rng.uniform(0, 3), rng.uniform(0, 3)) for i in range(60)]
    targets += [(100 + i, rng.uniform(-40, 40), rng.uniform(-40, 40)) for i in range(15)] + [(5000, 10.0, 10.0), (4000, 10.0, 10.0)]
    points.append((903, 10.0, 10.0))
    near = joins.nearest_within(
        table(points, "p int, longitude double, latitude double"),
        table(targets, "id int, longitude double, latitude double"), 9.0, **limits,
    )
    got = {r["p"]: r["id"] for r in near.collect()}
    assert got == brute_nearest(points, targets, 9.0)
    assert got[903] == 4000


def test_nearest_at_the_threshold(table, rows):
    points = table([("at", 0.0, 0.0), ("beyond", 100.0, 0.0), ("between", 50.0, 0.0)], "p string, longitude double, latitude double")
    targets = table([(1, 3.0, 0.0), (2, 103.1, 0.0), (4, 49.0, 0.0), (3, 51.0, 0.0)], "id int, longitude double, latitude double")
    for limits in ({}, {"list_bound": 0}, {"max_rows": 0}):
        near = joins.nearest_within(points, targets, 3.0, how="left", **limits)
        assert rows(near, "p", "id", "distance") == [("at", 1, 3.0), ("between", 3, 1.0), ("beyond", None, None)]


def test_nearest_to_few_targets_does_not_shuffle_points(table):
    points = table([(1, 0.0, 0.0)], "p int, longitude double, latitude double")
    targets = table([(1, 1.0, 1.0)], "id int, longitude double, latitude double")
    text = joins.nearest_within(points, targets, 3.0)._jdf.queryExecution().executedPlan().toString()
    assert text.split("BroadcastExchange")[0].count("Exchange") == 0
    none = joins.nearest_within(points, targets.filter("id > 1"), 3.0, how="left")
    assert none.first()["id"] is None


def test_first_per_key_and_anti(table, rows):
    cities = table([(2, "Rome", "Italy"), (1, "Rome", "USA"), (3, "Oslo", "Norway")], "id int, name string, country string")
    assert rows(joins.first_per_key(cities, "name", "id")) == [("Oslo", 3, "Norway"), ("Rome", 1, "USA")]
    assert rows(joins.without_match(cities, table([("Rome",)], "name string"), "name"), "name") == [("Oslo",)]


def test_domain_and_known_values(table, rows):
    df = table([("Positive",), ("other",), (None,), ("NEUTRAL",), ("Unknown",), ("NULL",)], "s string")
    assert rows(filters.in_domain(df, "s")) == [("NEUTRAL",), ("Positive",)]
    assert rows(filters.equals_ignoring_case(df, "s", "neutral")) == [("NEUTRAL",)]
    assert rows(filters.known_values(df, "s")) == [("NEUTRAL",), ("Positive",), ("other",)]


def test_agreement_and_disagreement(table, rows):
    df = table([("p", "p"), ("n", "p"), (None, "p")], "gold string, label string")
    assert tuple(stats.agreement(df, "gold", "label").first()) == (1, 2)
    assert rows(stats.disagreements(df, "gold", "label")) == [("n", "p")]


def test_join_by_frequency_is_a_left_join(table, rows, monkeypatch):
    """Frequent, rare, unmatched and null keys, repeated lookup rows, and any bound on the frequent keys."""
    facts = table([("a", i) for i in range(40)] + [("b", i) for i in range(9)] + [("x", 1), ("x", 2), ("c", 1), (None, 1), (None, 2), ("y", 3)], "k string, i int")
    lookup = table([("a", 1), ("b", 2), ("b", 3), ("c", 4), (None, 5), ("z", 6)], "k string, n int")
    expected = rows(facts.join(lookup, "k", "left"))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    for max_rows in (0, 1, 2, 100):
        assert rows(joins.join_by_frequency(facts, lookup, "k", max_rows)) == expected
    assert rows(joins.frequent_keys(facts, ["k"], 1, 1 << 20)) == [("a",)]
    assert rows(joins.frequent_keys(facts, ["k"], 2, 1 << 20)) == [("a",), ("b",)]
