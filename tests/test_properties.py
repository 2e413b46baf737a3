"""Laws that hold for any rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st

from tallywing.operators import cleaning, ranking, stats

values = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "NULL", ""]))
tables = st.lists(st.tuples(values, values), min_size=1, max_size=25)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(data=tables)
def test_dedup_keeps_one_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k string, v string")
    kept = cleaning.dedup(df, ["k"]).collect()
    assert sorted(map(str, (r["k"] for r in kept))) == sorted(map(str, {k for k, _ in data}))
    assert all(tuple(r) in data for r in kept)
    assert tuple(cleaning.dedup_counts(df, ["k"]).first()) == (len(data), len(kept))


@few
@given(data=tables)
def test_counts_add_up_and_modes_are_modes(spark, data):
    df = spark.createDataFrame(data, "k string, v string")
    assert sum(r["n"] for r in ranking.counts(df, "k", "v").collect()) == len(data)
    known = Counter(v for _, v in data if v is not None)
    mode = ranking.most_common(df, "v").first()
    assert (mode is None) == (not known)
    if known:
        assert mode["n"] == max(known.values()) and mode["v"] == min(v for v, n in known.items() if n == mode["n"])
    assert {r["v"]: r["n"] for r in stats.value_counts(df, "v").collect()} == dict(known)


@few
@given(data=tables, n=st.integers(1, 3))
def test_top_per_group_is_the_head_of_each_group(spark, data, n):
    df = spark.createDataFrame(data, "k string, v string")
    got = [(r["k"], r["rank"], r["v"], r["n"]) for r in ranking.top_per_group(df, "k", "v", n).collect()]
    want = []
    for k in {k for k, _ in data}:
        tally = Counter(v for g, v in data if g == k)
        ranked = sorted(tally.items(), key=lambda t: (-t[1], t[0] is not None, t[0] or ""))
        want += [(k, i + 1, v, c) for i, (v, c) in enumerate(ranked[:n])]
    assert sorted(map(str, got)) == sorted(map(str, want))
