"""What the plans must look like, and that results do not depend on how rows are spread."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from driver_queries.registry import ORACLES, QUERIES, table as load
from tallywing.operators import cleaning, ranking, stats
from tallywing.operators.sentiment import scores, vocabulary

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rankings_cut_before_the_shuffle(spark):
    part = load(spark, SF, "part")
    for df in (ranking.top_per_group(part, "p_brand", "p_type"), ranking.top_per_group(part, "p_brand", "p_type", one_per_count=True)):
        assert plan(df).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(ranking.top_n(part, "p_brand", 3))


def test_dedup_drops_copies_before_the_shuffle(spark):
    assert plan(cleaning.dedup(load(spark, SF, "lineitem"), ["l_orderkey", "l_linenumber"])).count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_used(spark):
    text = plan(ranking.counts(load(spark, SF, "lineitem").filter("l_quantity > 10"), "l_returnflag"))
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in text
    assert "GreaterThan(l_quantity,10.0)" in text


def test_reports_aggregate_in_one_pass(spark):
    events = load(spark, SF, "events")
    assert plan(stats.pivot_counts(events, "event_type", "props", ["a", "b"])).count("Exchange") == 1
    assert plan(stats.null_profile(events)).count("FileScan") == 1


def test_token_pass_shuffles_run_sums_not_tokens(spark, table):
    lexicon = table([("the", "n", 1.0, 0.0)], "word string, pos string, pos_score double, neg_score double")
    text = plan(scores(load(spark, SF, "documents"), "doc_id", "text", vocabulary(lexicon)))
    assert "BroadcastHashJoin" in text
    # Tokens are summed per run and then per document; the text itself is not copied to its runs.
    assert text.count("Exchange hashpartitioning(doc_id") == 2
    assert text.index("Exchange hashpartitioning(doc_id") < text.index("partial_sum(delta") < text.index("BroadcastHashJoin")
    assert ", text#" not in text[: text.index("FileScan")]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    for name in names.split():
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def normal(row):
    return tuple(str(float(v)) if isinstance(v, float) else str(v) for _, v in sorted(row.items()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, db, name):
    df = queries()[name](spark, SF)
    text = plan(df)
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(normal(dict(zip(columns, r))) for r in cursor.fetchall())
    assert sorted(normal(r.asDict()) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["top_reasons_collapse", "stats_by_group", "dedup_keys", "sentiment_all", "nearest_within", "fill_group_mode"])
def test_partition_count_does_not_matter(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append(sorted(normal(r.asDict()) for r in queries()[name](spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
