"""Missing values, labels, duplicates and data-quality summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, r6, table
from tallywing.functions.values import marker_to_null, override
from tallywing.operators import cleaning, stats
from tallywing.operators.joins import first_per_key, without_match
from tallywing.operators.sentiment import match_flags


@query("""
with g as (select event_id, case when event_type = 'error' then null else value end as value from events)
select event_id, round(coalesce(value, (select avg(value) from g)), 6) as value from g""")
def fill_mean(spark, sf):
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "case when event_type = 'error' then null else value end as value"
    )
    return cleaning.fill_mean(rows, "value").withColumn("value", r6("value"))


LABELLED = "documents left join labels using (doc_id)"


def labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


@query(f"""
select doc_id, coalesce(case quality when 1 then 'positive' when 0 then 'negative' end, 'Unknown') as gold,
       coalesce(toxic = 1, false) as toxic, cast(coalesce(quality, 0) as integer) as quality, 'tweet' as kind from {LABELLED}""")
def fill_constants(spark, sf):
    rows = labelled(spark, sf).selectExpr(
        "doc_id", "case quality when 1 then 'positive' when 0 then 'negative' end as gold", "toxic = 1 as toxic", "quality"
    )
    filled = cleaning.fill_constants(rows, {"gold": "Unknown", "toxic": False, "quality": 0})
    return filled.withColumn("kind", F.lit("tweet"))


@query("""
with m as (select event_id, case when event_type = 'click' then 'NULL' when event_type = 'view' then null else event_type end as event_type from events)
select event_type as value, cast(count(*) as bigint) as n from (select nullif(event_type, 'NULL') as event_type from m) group by 1
union all
select 'missing before', count(*) filter (where event_type is null or event_type = 'NULL') from m""")
def null_marker(spark, sf):
    marked = table(spark, sf, "events").selectExpr(
        "case when event_type = 'click' then 'NULL' when event_type = 'view' then null else event_type end as event_type"
    )
    cleaned = marked.select(marker_to_null(F.col("event_type")).alias("value"))
    report = marked.agg(stats.missing_count(F.col("event_type")).alias("n"))
    return cleaned.groupBy("value").agg(F.count("*").alias("n")).unionByName(
        report.select(F.lit("missing before").alias("value"), "n")
    )


CROWD = f"""select doc_id, case n_chars % 3 when 0 then 'negative' when 1 then 'neutral' else 'positive' end as label,
       case quality when 1 then 'positive' when 0 then 'negative' end as gold from {LABELLED}"""


def crowd(spark, sf):
    return labelled(spark, sf).selectExpr(
        "doc_id",
        "case n_chars % 3 when 0 then 'negative' when 1 then 'neutral' else 'positive' end as label",
        "case quality when 1 then 'positive' when 0 then 'negative' end as gold",
    )


@query(f"""with s as ({CROWD})
select doc_id, coalesce(gold, label) as label, coalesce(gold, 'Unknown') as gold from s""")
def gold_override(spark, sf):
    merged = crowd(spark, sf).withColumn("label", override(F.col("gold"), F.col("label")))
    return cleaning.fill_constants(merged, {"gold": "Unknown"})


@query(f"with s as ({CROWD}) select * from s where gold is not null and gold <> label")
def label_disagreement(spark, sf):
    return stats.disagreements(crowd(spark, sf), "gold", "label")


@query(f"""with s as ({CROWD})
select count(*) filter (where gold = label) as matching, count(gold) as with_gold from s""")
def label_agreement(spark, sf):
    return stats.agreement(crowd(spark, sf), "gold", "label")


@query(f"""with s as ({CROWD})
select doc_id, cast(case when gold = label then 1 else 0 end as integer) as label_is_matching from s""")
def label_match_flag(spark, sf):
    return match_flags(crowd(spark, sf), "gold", ["label"]).select("doc_id", "label_is_matching")


SPARSE = """select event_id, nullif(event_type, 'click') as a,
       case when event_type = 'view' or event_type = 'click' then null else props end as b from events"""


def sparse(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "nullif(event_type, 'click') as a",
        "case when event_type = 'view' or event_type = 'click' then null else props end as b",
    )


@query(f"with s as ({SPARSE}) select * from s where a is not null or b is not null")
def drop_all_null(spark, sf):
    return cleaning.drop_if_missing(sparse(spark, sf), ["a", "b"], "all")


@query(f"with s as ({SPARSE}) select * from s where a is not null and b is not null")
def drop_any_null(spark, sf):
    return cleaning.drop_if_missing(sparse(spark, sf), ["a", "b"], "any")


@query("""
with r as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) rn from lineitem)
select * exclude (rn) from r where rn = 1""")
def dedup_keys(spark, sf):
    return cleaning.dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select distinct * from (select * from lineitem union all select * from lineitem where l_quantity < 20)")
def dedup_rows(spark, sf):
    """Whole rows, some of which are there twice."""
    rows = table(spark, sf, "lineitem")
    return rows.unionAll(rows.filter("l_quantity < 20")).distinct()


@query("""
select p_name, min(p_partkey) as p_partkey, arg_min(p_brand, p_partkey) as p_brand from part group by p_name""")
def dedup_lookup(spark, sf):
    return first_per_key(table(spark, sf, "part").select("p_name", "p_partkey", "p_brand"), "p_name", "p_partkey")


@query("""
select count(*) as rows_before, (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as rows_after
from lineitem""")
def dedup_counts(spark, sf):
    return cleaning.dedup_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select count(*) as rows from events")
def row_count(spark, sf):
    return table(spark, sf, "events").agg(F.count("*").alias("rows"))


@query("select distinct event_type from events")
def distinct_values(spark, sf):
    return table(spark, sf, "events").select("event_type").distinct()


@query(f"with s as ({SPARSE}) select a, count(*) as n from s where a is not null group by a")
def value_counts(spark, sf):
    return stats.value_counts(sparse(spark, sf), "a")


@query("""
select count(distinct text) as distinct_values, count(*) as rows,
       round(cast(count(distinct text) as double) / count(*), 6) as ratio from documents""")
def distinct_ratio(spark, sf):
    return stats.distinct_ratio(table(spark, sf, "documents"), "text").withColumn("ratio", r6("ratio"))


@query(f"""
with s as (select doc_id, text, lang, source, quality, toxic from {LABELLED}),
p as ({" union all ".join(f"select '{c}' as column_name, count(*) filter (where {c} is null) as nulls from s"
                         for c in ("doc_id", "text", "lang", "source", "quality", "toxic"))})
select column_name, nulls from p where nulls > 0""")
def null_profile(spark, sf):
    return stats.null_profile(labelled(spark, sf).select("doc_id", "text", "lang", "source", "quality", "toxic"))


@query("""
with s as (select cast(embedding[1] as double) as x, cast(embedding[2] as double) as y from embeddings),
d as (select x, case when y = 0 then 'NaN'::double else y end as y from s)
select bool_or(isnan(x)) as x_nan, bool_or(isinf(x)) as x_inf, bool_or(isnan(y)) as y_nan, bool_or(isinf(y)) as y_inf from d""")
def nonfinite_check(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y")
    )
    rows = rows.withColumn("y", F.when(F.col("y") == 0, F.lit(float("nan"))).otherwise(F.col("y")))
    return stats.nonfinite_check(rows, "x", "y")


@query("select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def unresolved_rows(spark, sf):
    return without_match(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("""
select c_name as name, c_nationkey as nationkey, c_acctbal as acctbal, c_mktsegment as segment from customer
union all select s_name, s_nationkey, s_acctbal, null from supplier""")
def union_by_name(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_name as name", "c_nationkey as nationkey", "c_acctbal as acctbal", "c_mktsegment as segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_acctbal as acctbal", "s_name as name", "s_nationkey as nationkey")
    return cleaning.union_tables(customer, supplier)


@query("""
select sha256(length(o_orderkey::varchar) || ':' || o_orderkey || '|' || coalesce(length(c) || ':' || c, '-') || '|' || length(s) || ':' || s) as key, o_orderkey
from (select o_orderkey, nullif(o_custkey, o_custkey // 3 * 3)::varchar as c, o_orderstatus || '|' as s from orders)""")
def stable_row_key(spark, sf):
    """With nulls, and with the separator inside a value."""
    customer = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))
    key = cleaning.stable_key(F.col("o_orderkey"), customer, F.concat("o_orderstatus", F.lit("|")))
    return table(spark, sf, "orders").select(key.alias("key"), "o_orderkey")


@query("""
select o_orderkey, o_custkey as customer, o_orderpriority, o_orderpriority || '!' as shout from orders""")
def project_drop_rename(spark, sf):
    orders = cleaning.require_columns(table(spark, sf, "orders"), ["O_ORDERKEY", "o_custkey"])
    return (
        orders.withColumn("shout", F.concat("o_orderpriority", F.lit("!")))
        .withColumnRenamed("o_custkey", "customer")
        .drop("o_totalprice", "o_orderdate", "o_orderstatus")
    )
