"""Grouped statistics and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, r6, table
from tallywing.operators import distinct, stats
from tallywing.operators.ranking import top_n
from tallywing.plans import reports
from tallywing.plans.trust import trust_by_channel
from tallywing.session import settle


def events(spark, sf):
    return table(spark, sf, "events")


@query("""
select event_type, round(avg(value), 6) as mean_trusting_points, round(median(value), 6) as median_trusting_points
from events group by event_type""")
def mean_median_by_channel(spark, sf):
    out = trust_by_channel(events(spark, sf), "event_type", "value")
    return out.select("event_type", r6("mean_trusting_points").alias("mean_trusting_points"),
                      r6("median_trusting_points").alias("median_trusting_points"))


@query("""
select l_returnflag, round(avg(l_extendedprice), 6) as mean, round(median(l_extendedprice), 6) as median,
       count(l_extendedprice) as count, min(l_extendedprice) as min, max(l_extendedprice) as max
from lineitem group by l_returnflag""")
def stats_by_group(spark, sf):
    out = stats.summarize(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.withColumns({"mean": r6("mean"), "median": r6("median")})


@query("select l_returnflag, cast(sum(l_quantity) as double) as total from lineitem group by l_returnflag")
def sum_by_group(spark, sf):
    return reports.totals(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")


@query("""
select lang, count(quality) as judged, count(*) as n
from documents left join labels using (doc_id) group by lang""")
def count_nonnull(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("quality").alias("judged"), F.count("*").alias("n"))


@query("select l_suppkey, count(*) as n from lineitem group by l_suppkey order by n desc, l_suppkey limit 10")
def top_suppliers(spark, sf):
    return top_n(table(spark, sf, "lineitem"), "l_suppkey", 10)


# The event's value stands for its sentiment.
BUCKET = "case when value < 5 then 'negative' when value < 15 then 'neutral' else 'positive' end"


def opinions(spark, sf):
    return events(spark, sf).selectExpr("event_type", "ts", "user_id", "value", f"{BUCKET} as airline_sentiment")


@query(f"""
select event_type, {BUCKET} as airline_sentiment, count(*) as sentiment_count from events group by all""")
def sentiment_by_channel(spark, sf):
    return reports.sentiment_counts(opinions(spark, sf), "event_type")


@query(f"""
with s as (select event_type, {BUCKET} as b from events)
select event_type, count(*) filter (where b = 'positive') as positive, count(*) filter (where b = 'negative') as negative,
       count(*) filter (where b = 'neutral') as neutral from s group by event_type""")
def sentiment_by_channel_pivot(spark, sf):
    return reports.sentiment_pivot(opinions(spark, sf), "event_type")


@query(f"""
with s as (select user_id, {BUCKET} as b from events), p as (select * from s where b = 'positive')
select user_id, count(*) as n, round(cast(count(*) as double) * 100 / (select count(*) from p), 6) as percent
from p group by user_id""")
def share_by_group(spark, sf):
    return reports.sentiment_share(opinions(spark, sf), "user_id").withColumn("percent", r6("percent"))


@query(f"""
select strftime(ts, '%Y-%m-%d') as day, {BUCKET} as airline_sentiment, count(*) as n from events group by all""")
def daily_counts(spark, sf):
    out = reports.daily_counts(opinions(spark, sf), "ts")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""
with s as (select strftime(ts, '%Y-%m-%d') as day, {BUCKET} as b from events)
select day, count(*) filter (where b = 'positive') as positive, count(*) filter (where b = 'negative') as negative,
       count(*) filter (where b = 'neutral') as neutral from s group by day""")
def daily_pivot(spark, sf):
    return reports.daily_pivot(opinions(spark, sf), "ts").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("""
with p as (select n_nationkey as iso3, n_nationkey * 53 % 140 - 70.5 as latitude, n_nationkey * 97 % 360 - 179.5 as longitude
           from nation)
select iso3, round(cast(latitude as double), 6) as latitude, round(cast(longitude as double), 6) as longitude, count(*) as n
from customer join p on c_nationkey = iso3 where c_mktsegment = 'BUILDING' group by all""")
def country_heat(spark, sf):
    rows = table(spark, sf, "customer").selectExpr("c_nationkey as iso3", "c_mktsegment")
    countries = table(spark, sf, "nation").selectExpr(
        "n_nationkey as iso3", "cast(n_nationkey * 53 % 140 - 70.5 as double) as latitude",
        "cast(n_nationkey * 97 % 360 - 179.5 as double) as longitude",
    )
    return reports.country_heat(rows, countries, "c_mktsegment", "BUILDING")


@query("""
with s as (select p_brand, avg(p_retailprice) a, median(p_retailprice) m, count(p_retailprice) c,
                  min(p_retailprice) lo, max(p_retailprice) hi from part group by p_brand),
c as (select p_brand, p_type, count(*) n from part group by all),
r as (select *, row_number() over (partition by p_brand order by n desc, p_type) rk from c),
t as (select p_brand, string_agg(p_type, '|' order by rk) as top_reasons from r where rk <= 5 group by p_brand)
select p_brand, round(a, 6) as mean, round(m, 6) as median, c as count, lo as min, hi as max, top_reasons
from s join t using (p_brand)""")
def group_profile(spark, sf):
    out = reports.group_profile(table(spark, sf, "part"), "p_brand", "p_retailprice", "p_type")
    return out.withColumns({"mean": r6("mean"), "median": r6("median"), "top_reasons": F.concat_ws("|", "top_reasons")})


@query("""
with days as (select distinct cast(ts as date) as d from events),
spans as (select d as first_day, cast(d + interval 6 day as date) as last_day from days
          union select min(d), max(d) from days),
v as (select first_day, last_day, count(distinct event_id) as events, count(distinct user_id) as users
      from spans join events on cast(ts as date) between first_day and last_day group by all)
select strftime(first_day, '%Y-%m-%d') as first_day, strftime(last_day, '%Y-%m-%d') as last_day, events, users, true as near_events, true as near_users
from v""")
def distinct_over_spans(spark, sf):
    """Distinct events and users of every week and of all days: counted from the rows, and merged from one sketch a day."""
    rows = events(spark, sf)
    days = rows.select(F.to_date("ts").alias("day")).distinct()
    weeks = days.select(F.col("day").alias("first_day"), F.date_add("day", 6).alias("last_day"))
    spans = settle(weeks.union(days.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))))
    out = None
    for value, name in (("event_id", "events"), ("user_id", "users")):
        exact = distinct.exact_over(rows, spans, "ts", value).withColumnRenamed("values", name)
        merged = distinct.distinct_over(settle(distinct.daily_sketches(rows, "ts", value)), spans)
        near = (F.abs(F.col("values") - F.col(name)) <= F.col(name) * 0.05).alias(f"near_{name}")
        both = exact.join(merged, ["first_day", "last_day"]).select("first_day", "last_day", name, near)
        out = both if out is None else out.join(both, ["first_day", "last_day"])
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("first_day", "last_day")})
