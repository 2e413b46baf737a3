"""Registered queries against their SQL; whole tables of the smallest scale."""

import pytest

from tallywing.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "embeddings"):
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def normal(row):
    return tuple(str(v) for _, v in sorted(row.items()))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan
    if int(name[2:].split("_")[0]) in (1, 2, 7, 8, 9):  # native operators
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(normal(dict(zip(columns, r))) for r in cursor.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert sorted(normal(r.asDict()) for r in df.collect()) == want
