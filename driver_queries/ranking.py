"""Top-N, modes, reason choice and the reason pipeline."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from driver_queries.registry import query, table
from tallywing.functions.text import composite_key, split_composite_key, top_of_lists
from tallywing.operators.cleaning import fill_global_mode, fill_group_mode
from tallywing.operators.filters import in_domain, known_values, with_reason
from tallywing.operators.hooks import aggregate_with
from tallywing.operators.ranking import counts, most_common, most_common_per, top_lists, top_per_group
from tallywing.plans.countries import top_countries
from tallywing.plans.reasons import render_reasons, top_reasons


@query("""
with c as (select p_brand, p_type, count(*) n from part group by all),
m as (select p_brand, n, max(p_type) p_type from c group by p_brand, n),
r as (select *, row_number() over (partition by p_brand order by n desc) rk from m)
select p_brand, p_type, n, cast(rk as bigint) as rank from r where rk <= 5""")
def top_reasons_collapse(spark, sf):
    top = top_per_group(table(spark, sf, "part"), "p_brand", "p_type", 5, one_per_count=True)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("""
with c as (select p_brand, p_type, count(*) n from part group by all),
r as (select *, row_number() over (partition by p_brand order by n desc, p_type) rk from c)
select p_brand, string_agg(p_type, '|' order by rk) as top_types from r where rk <= 5 group by p_brand""")
def top_reasons_array(spark, sf):
    top = top_lists(table(spark, sf, "part"), "p_brand", "p_type", 5, "top_types")
    return top.withColumn("top_types", F.concat_ws("|", "top_types"))


@query("""
with c as (select p_brand, p_type, count(*) n from part group by all),
r as (select *, row_number() over (partition by p_brand order by n desc, p_type) rk from c)
select p_brand, string_agg(p_type, '|' order by rk) as top_types from r where rk <= 3 group by p_brand""")
def top_of_parallel_lists(spark, sf):
    """The list form: parallel lists of all values of a group and their counts, zipped, sorted and cut inside one row."""
    tally = counts(table(spark, sf, "part"), "p_brand", "p_type")
    pairs = tally.groupBy("p_brand").agg(F.collect_list(F.struct("p_type", "n")).alias("pairs"))
    best = top_of_lists(F.col("pairs.p_type"), F.col("pairs.n"), 3)
    return pairs.select("p_brand", F.concat_ws("|", best).alias("top_types"))


# Two reason columns with both spellings of missing, from the order priority.
REASONS = {
    "airline": "case when o_custkey % 13 = 0 then 'NULL' when o_custkey % 17 = 0 then '' else o_orderstatus end",
    "reason1": "case when o_orderkey % 5 = 0 then 'Unknown' when o_orderkey % 7 = 0 then 'NULL'"
    " when o_orderkey % 11 = 0 then '' else o_orderpriority end",
    "reason2": "case when o_orderkey % 3 = 0 then 'Unknown' when o_orderkey % 4 = 0 then 'NULL'"
    " else o_orderpriority end",
}
REASON_COLUMNS = ", ".join(f"{e} as {n}" for n, e in REASONS.items())
CHOSEN = f"""
with s as (select o_orderkey, o_custkey, {REASON_COLUMNS} from orders),
v as (select *, case when reason1 = 'Unknown' and reason2 <> 'NULL' then reason2 else reason1 end as reason from s
      where not (airline in ('', 'NULL')
                 or (reason1 in ('', 'NULL', 'Unknown') and reason2 in ('', 'NULL', 'Unknown')))),
k as (select * from v where reason not in ('', 'NULL'))"""


def reason_rows(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", *[f"{e} as {n}" for n, e in REASONS.items()]
    )


@query(f"{CHOSEN} select o_orderkey, airline, reason from k")
def valid_reason_choice(spark, sf):
    return with_reason(reason_rows(spark, sf), "airline", "reason1", "reason2").select("o_orderkey", "airline", "reason")


@query(f"""
with s as (select o_orderkey, {REASON_COLUMNS} from orders)
select o_orderkey, airline, reason1 from s
where airline not in ('NULL', 'Unknown') and reason1 not in ('NULL', 'Unknown')""")
def known_value_filter(spark, sf):
    return known_values(reason_rows(spark, sf), "airline", "reason1").select("o_orderkey", "airline", "reason1")


@query(f"""{CHOSEN},
g as (select c_mktsegment as airline, reason from k join customer on o_custkey = c_custkey),
c as (select airline, reason, count(*) n from g group by all),
m as (select airline, n, max(reason) reason from c group by airline, n),
r as (select *, row_number() over (partition by airline order by n desc) rk from m)
select airline, reason || '_' || cast(n as varchar) as reason_count from r where rk <= 5""")
def reasons_pipeline(spark, sf):
    segment = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = reason_rows(spark, sf).join(segment, "o_custkey")
    missing = F.col("airline").isin("", "NULL")
    rows = rows.withColumn("airline", F.when(missing, F.col("airline")).otherwise(F.col("c_mktsegment")))
    return render_reasons(top_reasons(rows, "airline", "reason1", "reason2"))


@query("""
with k as (select o_orderkey, o_orderstatus || '_' || o_orderpriority || '_x' as key from orders)
select o_orderkey, key, substr(key, 1, strpos(key, '_') - 1) as left_part,
       substr(key, strpos(key, '_') + 1) as right_part from k""")
def composite_key_roundtrip(spark, sf):
    key = composite_key(F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit("x"))
    left, right = split_composite_key(F.col("key"))
    rows = table(spark, sf, "orders").select("o_orderkey", key.alias("key"))
    return rows.withColumns({"left_part": left, "right_part": right})


# Order status stands for the sentiment, the customer's nation for the country code.
STATUS_SENTIMENT = (
    "case o_orderstatus when 'F' then 'negative' when 'O' then 'positive' when 'P' then 'neutral' else 'other' end"
)
TOP_COUNTRIES = f"""
with s as (select cast(c_nationkey as varchar) as iso3, {STATUS_SENTIMENT} as airline_sentiment
           from orders join customer on o_custkey = c_custkey)
select n_name as country, count(*) as n from s join nation on iso3 = cast(n_nationkey as varchar)
where upper(airline_sentiment) = 'NEGATIVE' group by n_name"""


def country_rows(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_custkey as c_custkey", f"{STATUS_SENTIMENT} as airline_sentiment")
    customer = table(spark, sf, "customer").selectExpr("c_custkey", "cast(c_nationkey as string) as iso3")
    return orders.join(customer, "c_custkey")


def nation_codes(spark, sf):
    return table(spark, sf, "nation").selectExpr("cast(n_nationkey as string) as code", "n_name as name")


@query(f"{TOP_COUNTRIES} order by n desc, country limit 5")
def topn_countries(spark, sf):
    return top_countries(country_rows(spark, sf), nation_codes(spark, sf), 5, "Negative")


@query(TOP_COUNTRIES)
def topn_all(spark, sf):
    return top_countries(country_rows(spark, sf), nation_codes(spark, sf), -1, "negative")


@query("select event_id, event_type from events where upper(event_type) in ('CLICK', 'VIEW', 'PURCHASE')")
def domain_validator(spark, sf):
    return in_domain(table(spark, sf, "events"), "event_type", ["click", "view", "purchase"]).select(
        "event_id", "event_type"
    )


@query("""
with c as (select r_name, c_mktsegment, count(*) n from customer join nation on c_nationkey = n_nationkey
           join region on n_regionkey = r_regionkey group by all),
r as (select *, row_number() over (partition by r_name order by n desc, c_mktsegment) rk from c)
select r_name, c_mktsegment, n from r where rk = 1""")
def mode_by_group(spark, sf):
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return most_common_per(rows, "r_name", "c_mktsegment")


GAPPED = "select event_id, nullif(event_type, 'error') as event_type from events"
MODE = f"""g as ({GAPPED}),
m as (select event_type, count(*) n from g where event_type is not null group by 1 order by n desc, event_type limit 1)"""


def gapped_events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"))


@query(f"with {MODE} select event_type, n from m")
def mode_global(spark, sf):
    return most_common(gapped_events(spark, sf), "event_type")


@query(f"with {MODE} select event_id, coalesce(g.event_type, (select event_type from m)) as event_type from g", name="fill_global_mode")
def fill_mode_global(spark, sf):
    return fill_global_mode(gapped_events(spark, sf), "event_type")


@query(f"with {MODE} select count(*) filter (where event_type is null) as filled from g")
def fill_mode_count(spark, sf):
    """Rows the fill will touch, counted before it."""
    return gapped_events(spark, sf).agg(F.count_if(F.col("event_type").isNull()).alias("filled"))


@query("""
with g as (select c_custkey, c_nationkey,
                  case when c_nationkey = 3 or c_custkey % 4 = 0 then null else c_mktsegment end as segment from customer),
c as (select c_nationkey, segment, count(*) n from g where segment is not null group by all),
r as (select *, row_number() over (partition by c_nationkey order by n desc, segment) rk from c)
select c_custkey, g.c_nationkey, coalesce(g.segment, r.segment, 'Unknown') as segment
from g left join r on g.c_nationkey = r.c_nationkey and rk = 1""", name="fill_group_mode")
def fill_mode_by_group(spark, sf):
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_nationkey",
        "case when c_nationkey = 3 or c_custkey % 4 = 0 then null else c_mktsegment end as segment",
    )
    return fill_group_mode(rows, "c_nationkey", "segment")


def _fold(state, frame):
    state = Counter() if state is None else state
    state.update(frame["p_type"].dropna())
    return state


def _merge(one, other):
    one.update(other)
    return one


def _finish(state):
    """One value for each count, the greatest, and the five largest counts."""
    held = {}
    for value, n in state.items():
        held[n] = max(value, held.get(n, value))
    best = sorted(held.items(), reverse=True)[:5]
    return pd.DataFrame({"p_type": [v for _, v in best], "n": [n for n, _ in best], "rank": range(1, len(best) + 1)})


@query("""
with c as (select p_brand, p_type, count(*) n from part group by all),
m as (select p_brand, n, max(p_type) p_type from c group by p_brand, n),
r as (select *, row_number() over (partition by p_brand order by n desc) rk from m)
select p_brand, p_type, n, cast(rk as bigint) as rank from r where rk <= 5""")
def top_reasons_hook(spark, sf):
    """The ranking as a user's own aggregation: states are folded where rows are read, then merged."""
    return aggregate_with(table(spark, sf, "part"), "p_brand", ["p_type"], _fold, _merge, _finish, "p_type string, n long, rank long")
