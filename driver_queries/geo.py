"""Nearest-target join."""

from __future__ import annotations

from driver_queries.registry import query, r6, table
from tallywing.operators.joins import nearest_within

# Coordinates derived from keys and balances; the same expressions on both sides.
POINT = "(c_custkey * 7919 % 36000) / 100.0e0 - 180 as longitude, c_acctbal / 100.0e0 - 45 as latitude"
TARGET = "(s_suppkey * 104729 % 36000) / 100.0e0 - 180 as longitude, s_acctbal / 100.0e0 - 45 as latitude"


@query(f"""
with p as (select c_custkey, {POINT} from customer), t as (select s_suppkey, s_nationkey, {TARGET} from supplier),
d as (select c_custkey, s_suppkey, s_nationkey,
             sqrt((p.longitude - t.longitude) * (p.longitude - t.longitude) + (p.latitude - t.latitude) * (p.latitude - t.latitude)) as d
      from p, t),
r as (select *, row_number() over (partition by c_custkey order by d, s_suppkey) rn from d where d <= 8)
select c_custkey, s_suppkey, s_nationkey, round(d, 6) as distance from r where rn = 1""", name="nearest_within")
def nearest_supplier(spark, sf):
    points = table(spark, sf, "customer").selectExpr("c_custkey", *POINT.split(", "))
    targets = table(spark, sf, "supplier").selectExpr("s_suppkey", "s_nationkey", *TARGET.split(", "))
    near = nearest_within(points, targets, 8.0, target_id="s_suppkey", keep=["s_nationkey"])
    return near.select("c_custkey", "s_suppkey", "s_nationkey", r6("distance").alias("distance"))
