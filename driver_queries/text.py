"""String, date, coordinate and tokenizing expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, r6, table
from tallywing.constants import COORDINATE_PATTERN, WORK_TIME_FORMATS
from tallywing.functions import text as T
from tallywing.functions.geo import coordinates, find_pair, parse_pair
from tallywing.functions.timestamps import parse_minute
from tallywing.operators.sentiment import classify_with, tokenize
from tallywing.session import spread


def documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


@query(r"""
select doc_id, sha256(regexp_replace(text, '[\n\r\t]', '', 'g')) as removed,
       sha256(regexp_replace(text, '[\n\r\t]', ' ', 'g')) as spaced from documents""")
def strip_control(spark, sf):
    body = F.col("text")
    return documents(spark, sf).select(
        "doc_id",
        F.sha2(T.replace_control(body), 256).alias("removed"),
        F.sha2(T.replace_control(body, " "), 256).alias("spaced"),
    )


@query("""select doc_id, sha256(replace(text, '"', '''')) as quoted from documents""")
def quotes_to_single(spark, sf):
    return documents(spark, sf).select("doc_id", F.sha2(T.single_quotes(F.col("text")), 256).alias("quoted"))


@query("select event_id, upper(trim('  ' || event_type || ' ')) as event_type from events")
def trim_fold(spark, sf):
    padded = F.concat(F.lit("  "), "event_type", F.lit(" "))
    return table(spark, sf, "events").select("event_id", T.fold(padded).alias("event_type"))


@query(r"""
with s as (select doc_id, string_split_regex(text, '\r?\n|&') as p from documents)
select doc_id, sha256(trim(p[1])) as first_item, sha256(trim(p[2])) as second_item from s""")
def split_multi_value(spark, sf):
    first, second = T.split_items(F.col("text"), 2)
    return documents(spark, sf).select(
        "doc_id", F.sha2(first, 256).alias("first_item"), F.sha2(second, 256).alias("second_item")
    )


@query("select doc_id, sha256(split_part(text, ',', 1)) as city from documents")
def before_comma(spark, sf):
    return documents(spark, sf).select("doc_id", F.sha2(T.before_comma(F.col("text")), 256).alias("city"))


# Coordinate text in the forms that occur: plain, bracketed, inside prose, no numbers, null.
COORD = (
    "case vec_id % 4 when 0 then concat(round(cast(embedding[{a}] as decimal(9,4)), 4), ',', round(cast(embedding[{b}] as decimal(9,4)), 4))"
    " when 1 then concat('[', round(cast(embedding[{a}] as decimal(9,4)), 4), ', ', round(cast(embedding[{b}] as decimal(9,4)), 4), ']')"
    " when 2 then 'New York, NY' end"
)
PLACE = "concat('Ort: ', round(cast(embedding[{b}] as decimal(9,4)), 4), ', ', label)"
SPARK_COORD, SPARK_PLACE = COORD.format(a=0, b=1), PLACE.format(b=1)
DUCK_COORD, DUCK_PLACE = COORD.format(a=1, b=2), PLACE.format(b=2)
SPLIT = """round(try_cast(string_split(translate(coord, '[]', ''), ',')[{i}] as double), 6)"""
FIND = f"round(try_cast(nullif(regexp_extract(place, '{COORDINATE_PATTERN}', {{i}}), '') as double), 6)"


def places(spark, sf):
    return table(spark, sf, "embeddings").selectExpr("vec_id", f"{SPARK_COORD} as coord", f"{SPARK_PLACE} as place")


PLACES = f"with s as (select vec_id, {DUCK_COORD} as coord, {DUCK_PLACE} as place from embeddings)"


@query(f"{PLACES} select vec_id, {SPLIT.format(i=1)} as latitude, {SPLIT.format(i=2)} as longitude from s")
def coords_split(spark, sf):
    latitude, longitude = parse_pair(F.col("coord"))
    return places(spark, sf).select("vec_id", r6(latitude).alias("latitude"), r6(longitude).alias("longitude"))


@query(f"{PLACES} select vec_id, {FIND.format(i=1)} as latitude, {FIND.format(i=2)} as longitude from s")
def coords_regex(spark, sf):
    latitude, longitude = find_pair(F.col("place"))
    return places(spark, sf).select("vec_id", r6(latitude).alias("latitude"), r6(longitude).alias("longitude"))


@query(f"""{PLACES}
select vec_id, case when coord is not null then {SPLIT.format(i=1)} else {FIND.format(i=1)} end as latitude,
       case when coord is not null then {SPLIT.format(i=2)} else {FIND.format(i=2)} end as longitude from s""")
def coords_either(spark, sf):
    latitude, longitude = coordinates(F.col("coord"), F.col("place"))
    return places(spark, sf).select("vec_id", r6(latitude).alias("latitude"), r6(longitude).alias("longitude"))


# Work times in the layouts that occur, and one that fits none.
SPARK_TIME = """case o_orderkey % 4
    when 0 then date_format(o_orderdate, 'M/d/yyyy') || ' 05:41:03' when 1 then date_format(o_orderdate, 'MM/dd/yyyy') || ' 17:08'
    when 2 then date_format(o_orderdate, 'M/d/yyyy') || ' 5:41' else 'about ' || date_format(o_orderdate, 'yyyy') end"""
DUCK_TIME = """case o_orderkey % 4
    when 0 then strftime(o_orderdate, '%-m/%-d/%Y') || ' 05:41:03' when 1 then strftime(o_orderdate, '%m/%d/%Y') || ' 17:08'
    when 2 then strftime(o_orderdate, '%-m/%-d/%Y') || ' 5:41' else 'about ' || strftime(o_orderdate, '%Y') end"""


@query(f"""
with s as (select o_orderkey, {DUCK_TIME} as t from orders)
select o_orderkey, strftime(date_trunc('minute', coalesce(try_strptime(t, '%m/%d/%Y %H:%M:%S'),
       try_strptime(t, '%m/%d/%Y %H:%M'))), '%Y-%m-%d %H:%M:%S') as created from s""")
def parse_timestamps(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"{SPARK_TIME} as t")
    return rows.select(
        "o_orderkey", F.date_format(parse_minute(F.col("t"), WORK_TIME_FORMATS), "yyyy-MM-dd HH:mm:ss").alias("created")
    )


WORDS = "regexp_extract_all(lower(text), '([\\p{L}\\p{M}'']+)')"


@query(f"""
select word, count(*) as n, count(distinct doc_id) as docs
from (select doc_id, unnest({WORDS}) as word from documents) group by word""", name="tokenize")
def tokenize_documents(spark, sf):
    return tokenize(documents(spark, sf), "doc_id", "text").groupBy("word").agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs")
    )


@query("select doc_id, case when length(text) > 0 then sha256(text || ' + test') end as test from documents")
def udf_hook(spark, sf):
    """A user's own classifier, called on Arrow batches."""
    tested = classify_with(documents(spark, sf), "text", lambda t: t + " + test", "test")
    return tested.select("doc_id", F.sha2("test", 256).alias("test"))
