"""The end-to-end pipelines on a full 27-column feedback table derived from the driver tables.

Every document occurs twice with different work columns, so there is a duplicate to drop for each.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, r6, table
from driver_queries.sentiment import DOWN, NEGATION_LIST, POS, UP, VALENCE, WAYS, label_sql
from tallywing.constants import COORDINATE_PATTERN, LABEL_COLUMNS
from tallywing.functions.text import words
from tallywing.operators.sentiment import vocabulary
from tallywing.plans.clean import clean_feedback
from tallywing.plans.countries import resolve_countries, top_countries
from tallywing.plans.reasons import render_reasons, top_reasons
from tallywing.plans.reports import country_heat, daily_pivot, sentiment_share
from tallywing.plans.sentiment import classifier_accuracy, classify_feedback
from tallywing.plans.trust import trust_by_channel
from tallywing.session import scratch_path, settle, spread
from tallywing.sources.sinks import write_parquet


def _work_time(key: str) -> str:
    day = f"concat(({key}) % 12 + 1, '/', ({key}) % 28 + 1, '/2015 ', ({key}) % 24, ':', lpad(cast(({key}) % 60 as string), 2, '0'))"
    return f"case when ({key}) % 7 = 0 then 'some day' when ({key}) % 5 = 0 then {day} else concat({day}, ':03') end"


LATITUDE = "concat(doc_id * 7 % 141 - 70, '.5')"
LONGITUDE = "concat(doc_id * 13 % 361 - 180, '.25')"
# The same expressions give the table in both engines.
RAW = {
    "_unit_id": "doc_id * 2 + copy",
    "_created_at": _work_time("doc_id"),
    "_golden": "quality is not null",
    "_id": "doc_id + 1000000",
    "_missed": "case when doc_id % 3 = 0 then null else doc_id % 2 = 0 end",
    "_started_at": _work_time("doc_id + 1"),
    "_tainted": "false",
    "_channel": "lang",
    "_trust": "cast(doc_id * 37 % 1000 + copy as double) / 1000",
    "_worker_id": "doc_id % 50 + copy",
    "_country": "case when doc_id % 6 = 0 then null else concat('C', doc_id % 11) end",
    "_region": "'r'",
    "_city": "'c'",
    "_ip": "concat('10.0.0.', doc_id % 256)",
    "airline_sentiment": "case n_chars % 3 when 0 then 'negative' when 1 then 'neutral' else 'positive' end",
    "negativereason": "case doc_id % 4 when 1 then 'Late' when 2 then 'Lost' when 3 then 'Rude' end",
    "airline": "case when doc_id % 41 = 0 then 'NULL' else source end",
    "airline_sentiment_gold": "case quality when 1 then 'positive' when 0 then 'negative' end",
    "name": "concat('user', doc_id % 97)",
    "negativereason_gold": "case when quality = 0 then concat('Late', chr(10), 'Rude ') when quality = 1 and doc_id % 2 = 0"
    " then 'Lost&Late' when quality = 1 then 'Cancelled' end",
    "retweet_count": "case when doc_id % 5 = 0 then null else n_chars % 10 end",
    "text": "text",
    "tweet_coord": f"case when doc_id % 3 = 0 then concat({LATITUDE}, ',', {LONGITUDE}) end",
    "tweet_created": "concat(doc_id % 28 + 1, '/', doc_id % 12 + 1, '/2015 ', doc_id % 24, ':', lpad(cast(doc_id % 60 as string), 2, '0'))",
    "tweet_id": "570306133677760513 + doc_id",
    "tweet_location": "case when doc_id % 3 = 1 then concat('Supplier#', lpad(cast(doc_id % 150 as string), 9, '0'), ', somewhere')"
    f" when doc_id % 6 = 2 then concat('ÜT: ', {LATITUDE}, ', ', {LONGITUDE}) end",
    "user_timezone": "case when doc_id % 4 = 0 then null else concat('Z', doc_id * 7 % 5) end",
}
COPIES = "explode(array(0, 1)) as copy"


def raw_feedback(spark, sf):
    judged = spread(table(spark, sf, "documents"), "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return judged.selectExpr("*", COPIES).selectExpr(*[f"{e} as {n}" for n, e in RAW.items()])


# The cleaned table, step by step; duplicates keep the smallest work columns (unit id first).
CLEAN = f"""
raw as (select {", ".join(f"{e} as {n}" for n, e in RAW.items())}
        from documents left join labels using (doc_id) cross join (values (0), (1)) c(copy)),
ded as (select * exclude (rn) from (
  select *, row_number() over (partition by tweet_id, _id, text, tweet_created, name, _created_at order by _unit_id) rn from raw) where rn = 1),
par as (select * replace (
    try_strptime(tweet_created, '%d/%m/%Y %H:%M') as tweet_created,
    date_trunc('minute', coalesce(try_strptime(_created_at, '%m/%d/%Y %H:%M:%S'), try_strptime(_created_at, '%m/%d/%Y %H:%M'))) as _created_at,
    date_trunc('minute', coalesce(try_strptime(_started_at, '%m/%d/%Y %H:%M:%S'), try_strptime(_started_at, '%m/%d/%Y %H:%M'))) as _started_at,
    replace(regexp_replace(text, '[\\n\\r\\t]', '', 'g'), '"', '''') as text,
    coalesce(airline_sentiment_gold, airline_sentiment) as airline_sentiment,
    coalesce(airline_sentiment_gold, 'Unknown') as airline_sentiment_gold,
    coalesce(_country, 'Unknown') as _country, coalesce(_missed, false) as _missed, coalesce(retweet_count, 0) as retweet_count),
    string_split_regex(negativereason_gold, '\\r?\\n|&') as parts from ded),
rea as (select *, coalesce(trim(parts[1]), negativereason, 'Unknown') as negativereason1,
               coalesce(trim(parts[2]), 'Unknown') as negativereason2 from par),
tz as (select _country, user_timezone as zone, row_number() over (partition by _country order by count(*) desc, user_timezone) rk
       from rea where user_timezone is not null group by _country, user_timezone),
clean as (select rea.* replace (coalesce(user_timezone, zone, 'Unknown') as user_timezone)
          from rea left join tz on rea._country = tz._country and rk = 1)"""

SHOWN_TIMES = ("_created_at", "_started_at", "tweet_created")
CLEAN_COLUMNS = [
    c for c in RAW
    if c not in ("negativereason_gold", "negativereason", "_region", "_city", "_tainted", "text", "_trust", *SHOWN_TIMES)
] + ["negativereason1", "negativereason2"]


@query(f"""with {CLEAN}
select {", ".join(CLEAN_COLUMNS)}, round(_trust, 6) as _trust, sha256(text) as text,
       {", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') as {c}" for c in SHOWN_TIMES)} from clean""")
def clean_pipeline(spark, sf):
    cleaned = clean_feedback(raw_feedback(spark, sf))
    return cleaned.withColumns({
        "_trust": r6("_trust"), "text": F.sha2("text", 256),
        **{c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in SHOWN_TIMES},
    })


@query(f"""with {CLEAN}
select coalesce(tweet_location, 'Unknown') as tweet_location, coalesce(tweet_coord, 'Unknown') as tweet_coord, count(*) as n
from clean where tweet_location is not null or tweet_coord is not null group by all""")
def clean_located(spark, sf):
    """The form that keeps only rows with a location."""
    cleaned = clean_feedback(raw_feedback(spark, sf), require_location=True)
    return cleaned.groupBy("tweet_location", "tweet_coord").agg(F.count("*").alias("n"))


# Another key, NULL markers among the zones, the zone of all rows, mean retweets, and the trusted reason kept.
OPTION_ZONE = "case when _unit_id % 9 < 4 then 'NULL' else user_timezone end"
OPTIONS = f"""
raw as (select {", ".join(f"{e} as {n}" for n, e in RAW.items())}
        from documents left join labels using (doc_id) cross join (values (0), (1)) c(copy)),
ded as (select * exclude (rn) replace ({OPTION_ZONE} as user_timezone) from (
  select *, row_number() over (partition by text, _id order by _unit_id) rn from raw) where rn = 1),
par as (select * replace (nullif(user_timezone, 'NULL') as user_timezone, nullif(airline, 'NULL') as airline,
        replace(regexp_replace(text, '[\n\r\t]', ' ', 'g'), '"', '''') as text,
        regexp_replace(negativereason_gold, '[\n\r\t]', ',', 'g') as negativereason_gold),
        string_split_regex(negativereason_gold, '\r?\n|&') as parts from ded),
zone as (select user_timezone as zone from par where user_timezone is not null group by 1 order by count(*) desc, 1 limit 1),
mean as (select avg(retweet_count) as retweets from par)"""
KEPT_OPTIONS = ("_region", "_city", "_tainted")


def optional_feedback(spark, sf, watch=None):
    raw = raw_feedback(spark, sf).withColumn("user_timezone", F.expr(OPTION_ZONE))
    return clean_feedback(
        raw, drop=KEPT_OPTIONS, line_break=" ", dedup_keys=("text", "_id"), null_columns=("airline", "user_timezone"), zone_by=None,
        mean_retweets=True, reason_break=",", watch=watch)


@query(f"""with {OPTIONS}
select _unit_id, _id, airline, coalesce(user_timezone, zone) as user_timezone, sha256(text) as text, negativereason_gold,
    coalesce(trim(parts[1]), negativereason, 'Unknown') as negativereason1, coalesce(trim(parts[2]), 'Unknown') as negativereason2,
    round(coalesce(cast(retweet_count as double), retweets), 6) as retweet_count
from par, zone, mean""")
def clean_options(spark, sf):
    return optional_feedback(spark, sf).select(
        "_unit_id", "_id", "airline", "user_timezone", F.sha2("text", 256).alias("text"), "negativereason_gold", "negativereason1",
        "negativereason2", r6("retweet_count").alias("retweet_count"))


@query(f"""with {OPTIONS}
select 'read' as step, (select count(*) from raw) as rows union all select 'kept', count(*) from ded
union all select 'zones filled', count(*) filter (where user_timezone is null) from par union all select 'written', count(*) from ded""")
def clean_accounting(spark, sf):
    """Row counts of the cleaning steps, observed in the passes that write the cleaned table."""
    watch = {}
    written = write_parquet(optional_feedback(spark, sf, watch), scratch_path(spark, "cleaned"))
    found = [("read", watch["read"].get["rows"]), ("kept", watch["kept"].get["rows"]),
             ("zones filled", watch["filled"].get["zones"]), ("written", written)]
    return spark.createDataFrame(found, "step string, rows long")


@query(f"""with {CLEAN},
v as (select airline, case when negativereason1 = 'Unknown' and negativereason2 <> 'NULL' then negativereason2 else negativereason1 end as reason
      from clean where not (airline in ('', 'NULL') or (negativereason1 in ('', 'NULL', 'Unknown') and negativereason2 in ('', 'NULL', 'Unknown')))),
c as (select airline, reason, count(*) n from v where reason not in ('', 'NULL') group by all),
m as (select airline, n, max(reason) reason from c group by airline, n),
r as (select *, row_number() over (partition by airline order by n desc) rk from m)
select airline, reason || '_' || cast(n as varchar) as reason_count from r where rk <= 5""")
def feedback_top_reasons(spark, sf):
    return render_reasons(top_reasons(clean_feedback(raw_feedback(spark, sf))))


@query(f"""with {CLEAN}
select _channel, round(avg(_trust), 6) as mean_trusting_points, round(median(_trust), 6) as median_trusting_points
from clean group by _channel""")
def feedback_trust(spark, sf):
    out = trust_by_channel(clean_feedback(raw_feedback(spark, sf)))
    return out.withColumns({c: r6(c) for c in ("mean_trusting_points", "median_trusting_points")})


# Nations stand for the countries, suppliers for the cities.
COUNTRY = {
    "id": "n_nationkey", "name": "n_name", "iso3": "concat('N', lpad(cast(n_nationkey as string), 2, '0'))",
    "latitude": "cast(n_nationkey * 53 % 140 - 70 as double)", "longitude": "cast(n_nationkey * 97 % 360 - 180 as double)",
}
COUNTRY_SQL = ", ".join(f"{e} as {n}" for n, e in COUNTRY.items())


def countries(spark, sf):
    return table(spark, sf, "nation").selectExpr(*[f"{e} as {n}" for n, e in COUNTRY.items()])


def cities(spark, sf):
    nation = table(spark, sf, "nation").selectExpr("n_nationkey as s_nationkey", "n_name as country_name")
    return table(spark, sf, "supplier").join(nation, "s_nationkey").selectExpr("s_suppkey as id", "s_name as name", "country_name")


RESOLVED = f"""{CLEAN},
loc as (select *, try_cast(case when tweet_coord is not null then split_part(tweet_coord, ',', 1)
                 else nullif(regexp_extract(tweet_location, '{COORDINATE_PATTERN}', 1), '') end as double) as lat,
               try_cast(case when tweet_coord is not null then split_part(tweet_coord, ',', 2)
                 else nullif(regexp_extract(tweet_location, '{COORDINATE_PATTERN}', 2), '') end as double) as lon from clean),
countries as (select {COUNTRY_SQL} from nation),
near as (select _unit_id, iso3, row_number() over (partition by _unit_id order by
           sqrt((lat - latitude) * (lat - latitude) + (lon - longitude) * (lon - longitude)), id) rk
         from loc, countries where sqrt((lat - latitude) * (lat - latitude) + (lon - longitude) * (lon - longitude)) <= 30),
city as (select s_name, concat('N', lpad(cast(s_nationkey as string), 2, '0')) as code from supplier),
resolved as (select clean.*, coalesce(near.iso3, city.code) as iso3 from clean
             left join near on clean._unit_id = near._unit_id and rk = 1
             left join city on near.iso3 is null and split_part(clean.tweet_location, ',', 1) = city.s_name
             where coalesce(near.iso3, city.code) is not null)"""


def resolved_feedback(spark, sf):
    return resolve_countries(clean_feedback(raw_feedback(spark, sf)), cities(spark, sf), countries(spark, sf))


@query(f"with {RESOLVED} select _unit_id, _id, name, airline_sentiment, iso3 from resolved")
def two_step_resolve(spark, sf):
    return resolved_feedback(spark, sf).select("_unit_id", "_id", "name", "airline_sentiment", "iso3")


@query(f"""with {RESOLVED}
select n_name as country, count(*) as n from resolved join nation on iso3 = concat('N', lpad(cast(n_nationkey as string), 2, '0'))
where airline_sentiment = 'negative' group by n_name order by n desc, country limit 5""")
def feedback_top_countries(spark, sf):
    codes = countries(spark, sf).selectExpr("iso3 as code", "name")
    return top_countries(resolved_feedback(spark, sf), codes, 5, "negative")


@query(f"""with {RESOLVED}
select iso3, round(latitude, 6) as latitude, round(longitude, 6) as longitude, count(*) as n
from resolved left join countries using (iso3) where airline_sentiment = 'negative' group by all""")
def feedback_country_heat(spark, sf):
    return country_heat(resolved_feedback(spark, sf), countries(spark, sf))


@query(f"""with {CLEAN}, p as (select * from clean where airline_sentiment = 'positive')
select airline, count(*) as n, round(cast(count(*) as double) * 100 / (select count(*) from p), 6) as percent from p group by airline""")
def feedback_positive_share(spark, sf):
    cleaned = clean_feedback(raw_feedback(spark, sf))
    return sentiment_share(cleaned, "airline").withColumn("percent", r6("percent"))


@query(f"""with {CLEAN}
select strftime(tweet_created, '%Y-%m-%d') as day, count(*) filter (where airline_sentiment = 'positive') as positive,
       count(*) filter (where airline_sentiment = 'negative') as negative, count(*) filter (where airline_sentiment = 'neutral') as neutral
from clean group by 1""")
def feedback_daily(spark, sf):
    return daily_pivot(clean_feedback(raw_feedback(spark, sf))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


# Words for the classifier come from another table than the texts it judges.
WORD_SOURCE = "select distinct unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{M}'']+)')) as word from conversations"


def conversation_vocabulary(spark, sf):
    found = table(spark, sf, "conversations").select(F.explode(words(F.col("text"))).alias("word")).distinct()
    found = settle(found)
    lexicon = found.selectExpr("word", f"{POS} as pos", f"{UP} as pos_score", f"{DOWN} as neg_score")
    valences = found.selectExpr("word", f"{VALENCE} as valence")
    return settle(vocabulary(lexicon, found.filter("length(word) <= 2"), valences))


# The classifiers read texts whose line breaks and tabs became blanks.
SPACED = CLEAN.replace(r"'[\n\r\t]', ''", r"'[\n\r\t]', ' '")


def _classified_sql() -> str:
    labels = ", ".join(f"{label_sql(s, t)} as {n}" for n, (s, t) in zip(LABEL_COLUMNS, WAYS))
    return f"""with {SPACED},
judged as (select _unit_id as k, airline_sentiment_gold as gold, regexp_extract_all(lower(text), '([\\p{{L}}\\p{{M}}'']+)') as ws from clean),
tok as (select k, unnest(ws) as word, unnest(range(len(ws))) as pos from judged),
vocab_words as ({WORD_SOURCE}),
t as (select tok.*, case when length(word) % 5 <= 2 and v.word is not null then {UP} - {DOWN} end as delta, length(word) <= 2 as is_stop,
             tok.word in ({NEGATION_LIST}) as is_neg, case when v.word is not null then {VALENCE} end as valence
      from tok left join vocab_words v using (word)),
base as (select k, sum(delta) / count(delta) as score,
                sum(delta) filter (where not is_stop) / nullif(count(delta) filter (where not is_stop), 0) as score_no_stop,
                coalesce(sum(valence), 0) as v from t group by k),
negs as (select *, sum(is_neg::int) over (partition by k order by pos) as c from t),
plain as (select *, coalesce(lag(c) over (partition by k order by pos), 0) as before from negs where delta is not null and not is_neg),
flip as (select k, sum(case when (c - before) % 2 = 1 then -delta else delta end) / count(*) as score_negated from plain group by k),
scored as (select k, gold, coalesce(score, 0) as score, coalesce(score_no_stop, 0) as score_no_stop,
                  coalesce(score_negated, 0) as score_negated, coalesce(v, 0) / sqrt(coalesce(v, 0) * coalesce(v, 0) + 15) as compound
           from judged left join base using (k) left join flip using (k)),
labelled as (select k, gold, {labels} from scored)"""


def _accuracy_sql() -> str:
    rows = " union all ".join(
        f"select '{c}' as classifier, count(*) filter (where {c} = gold) as matches, count(*) as total,"
        f" round(cast(count(*) filter (where {c} = gold) as double) * 100 / count(*), 6) as accuracy from labelled where gold <> 'Unknown'"
        for c in LABEL_COLUMNS
    )
    return f"{_classified_sql()} {rows}"


@query(_accuracy_sql())
def feedback_accuracy(spark, sf):
    classified = classify_feedback(raw_feedback(spark, sf), conversation_vocabulary(spark, sf))
    return classifier_accuracy(classified).withColumn("accuracy", r6("accuracy"))


@query(f"""{_classified_sql()} select k as _unit_id, {", ".join(LABEL_COLUMNS)},
    {", ".join(f"cast({c} = gold as int) as {c}_is_matching" for c in LABEL_COLUMNS)} from labelled""")
def feedback_classified(spark, sf):
    """Every cleaned row with its labels; a filler matches no label."""
    classified = classify_feedback(raw_feedback(spark, sf), conversation_vocabulary(spark, sf))
    return classified.select("_unit_id", *LABEL_COLUMNS, *(f"{c}_is_matching" for c in LABEL_COLUMNS))
