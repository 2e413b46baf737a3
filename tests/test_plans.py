"""Pipelines on a hand-written feedback table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallywing.constants import LABEL_COLUMNS
from tallywing.operators.sentiment import vocabulary
from tallywing.plans import jobs, reports
from tallywing.plans.clean import clean_feedback
from tallywing.plans.countries import resolve_countries, top_countries
from tallywing.plans.reasons import render_reasons, top_reasons
from tallywing.plans.sentiment import classifier_accuracy, classify_feedback
from tallywing.plans.trust import trust_by_channel
from tallywing.sources.schemas import RAW_SCHEMA

BASE = {
    "_unit_id": 1, "_created_at": "2/25/2015 05:41:03", "_golden": False, "_id": 1, "_missed": None,
    "_started_at": "12/25/2015 5:40", "_tainted": False, "_channel": "web", "_trust": 0.5, "_worker_id": 9,
    "_country": "USA", "_region": "r", "_city": "c", "_ip": "ip", "airline_sentiment": "negative",
    "negativereason": "Late", "airline": "United", "airline_sentiment_gold": None, "name": "u", "negativereason_gold": None,
    "retweet_count": None, "text": 'very\n"bad"\tday', "tweet_coord": None, "tweet_created": "24/2/2015 11:35",
    "tweet_id": 570306133677760513, "tweet_location": None, "user_timezone": None,
}


@pytest.fixture
def raw(table):
    changes = [
        {},
        {"_unit_id": 2, "_worker_id": 10},
        {"_id": 2, "user_timezone": "Eastern", "negativereason_gold": "Lost\r\nRude", "airline_sentiment_gold": "negative"},
        {"_id": 3, "user_timezone": "Eastern", "airline_sentiment_gold": "positive", "text": "good", "tweet_coord": "1.0,2.0"},
        {"_id": 4, "user_timezone": "Pacific", "_country": None, "retweet_count": 4, "tweet_location": "Oslo, Norway"},
        {"_id": 5, "_country": "FRA", "airline": "NULL", "tweet_location": "ÜT: 50.5, 60.0", "_created_at": "never"},
        {"_id": 6, "_channel": "app", "_trust": 1.0, "tweet_location": "Nowhere", "tweet_id": 570306133677760514},
    ]
    rows = [{**BASE, **c} for c in changes]
    return table([tuple(r.values()) for r in rows], RAW_SCHEMA)


def test_cleaning(raw):
    cleaned = clean_feedback(raw)
    got = {r["_id"]: r for r in cleaned.collect()}
    assert len(cleaned.columns) == 24 and len(got) == 6
    assert got[1]["_unit_id"] == 1
    assert got[1]["text"] == "very'bad'day"
    assert (got[1]["_created_at"], got[1]["_started_at"], got[1]["tweet_created"]) == (
        datetime(2015, 2, 25, 5, 41), datetime(2015, 12, 25, 5, 40), datetime(2015, 2, 24, 11, 35)
    )
    assert got[5]["_created_at"] is None
    assert (got[1]["airline_sentiment"], got[1]["airline_sentiment_gold"]) == ("negative", "Unknown")
    assert got[3]["airline_sentiment"] == "positive"
    assert (got[2]["negativereason1"], got[2]["negativereason2"]) == ("Lost", "Rude")
    assert (got[1]["negativereason1"], got[1]["negativereason2"]) == ("Late", "Unknown")
    assert got[1]["user_timezone"] == "Eastern" and got[4]["user_timezone"] == "Pacific" and got[5]["user_timezone"] == "Unknown"
    assert got[4]["_country"] == "Unknown" and got[4]["retweet_count"] == 4 and got[1]["retweet_count"] == 0
    assert got[1]["_missed"] is False
    assert {r["tweet_id"] for r in got.values()} == {570306133677760513, 570306133677760514}


def test_cleaning_options(raw):
    plain = {r["_id"]: r for r in clean_feedback(raw, drop=(), fill=False, line_break=" ").collect()}
    assert plain[1]["user_timezone"] is None and plain[1]["airline_sentiment_gold"] is None and plain[4]["_country"] is None
    assert plain[1]["text"] == "very 'bad' day" and plain[1]["_tainted"] is False
    located = {r["_id"]: r for r in clean_feedback(raw, require_location=True).collect()}
    assert set(located) == {3, 4, 5, 6}
    assert located[3]["tweet_location"] == "Unknown" and located[4]["tweet_coord"] == "Unknown"


def test_reasons_and_trust(raw, rows):
    cleaned = clean_feedback(raw)
    assert [tuple(r) for r in render_reasons(top_reasons(cleaned)).collect()] == [("United", "Late_4"), ("United", "Lost_1")]
    assert rows(trust_by_channel(cleaned)) == [("app", 1.0, 1.0), ("web", 0.5, 0.5)]
    assert rows(trust_by_channel(cleaned, approximate=True)) == [("app", 1.0, 1.0), ("web", 0.5, 0.5)]


def test_countries(raw, table, rows):
    countries = table(
        [(1, "Norway", "NOR", 62.0, 10.0), (2, "Near", "NEA", 2.0, 2.0), (3, "Far", "FAR", 50.0, 89.0), (4, "Edge", "EDG", 50.5, 90.0)],
        "id int, name string, iso3 string, latitude double, longitude double",
    )
    cities = table([(2, "Oslo", "Far"), (1, "Oslo", "Norway"), (3, "Paris", "Atlantis")], "id int, name string, country_name string")
    cleaned = clean_feedback(raw)
    resolved = resolve_countries(cleaned, cities, countries)
    assert rows(resolved, "_id", "iso3") == [(3, "NEA"), (4, "NOR"), (5, "FAR")]
    assert set(cleaned.columns) - set(resolved.columns) == {"tweet_coord", "tweet_location"}
    codes = countries.select(F.col("iso3").alias("code"), "name")
    assert [tuple(r) for r in top_countries(resolved, codes, 5, "NEGATIVE").collect()] == [("Far", 1), ("Norway", 1)]
    assert [tuple(r) for r in top_countries(resolved, codes, 1, "positive").collect()] == [("Near", 1)]
    assert top_countries(resolved, codes, 0, "positive").count() == 0
    heat = reports.country_heat(resolved, countries)
    assert [tuple(r) for r in heat.collect()] == [("FAR", 50.0, 89.0, 1), ("NOR", 62.0, 10.0, 1)]


def test_classifiers(raw, table, rows):
    lexicon = table([("good", "a", 1.0, 0.0), ("bad", "a", 0.0, 1.0)], "word string, pos string, pos_score double, neg_score double")
    classified = classify_feedback(raw, vocabulary(lexicon))
    assert len(classified.columns) == 26 + 12
    # Control characters become blanks, so "very\n'bad'\tday" keeps its words; rows without gold are classified, too.
    found = rows(classified.filter("airline_sentiment_gold != 'Unknown'"), "_id", "sentiment", "sentiment_is_matching")
    assert [r[0] for r in found] == [2, 3] and found[1] == (3, "positive", 1)
    assert classified.count() == clean_feedback(raw).count()
    result = {r["classifier"]: (r["matches"], r["total"]) for r in classifier_accuracy(classified).collect()}
    assert result["sentiment"] == (1, 2) and set(result) == set(LABEL_COLUMNS)


def test_reports(raw, rows):
    cleaned = clean_feedback(raw)
    assert [tuple(r) for r in reports.sentiment_counts(cleaned, "_channel").collect()] == [
        ("web", "negative", 4), ("app", "negative", 1), ("web", "positive", 1)
    ]
    assert rows(reports.sentiment_pivot(cleaned, "_channel")) == [("app", 0, 1, 0), ("web", 1, 4, 0)]
    assert rows(reports.sentiment_share(cleaned, "airline")) == [("United", 1, 100.0)]
    assert reports.daily_counts(cleaned).count() == 2
    assert reports.daily_pivot(cleaned).first()[1:] == (1, 5, 0)
    profile = {r["airline"]: r for r in reports.group_profile(cleaned).collect()}
    assert profile["United"]["top_reasons"] == ["Late", "Lost"] and profile["United"]["median"] == 0.5
    assert rows(reports.totals(cleaned)) == [("NULL", 0), ("United", 4)]


def test_jobs_from_files_to_files(spark, raw, table, rows, tmp_path, monkeypatch):
    from tallywing.sources.files import read_countries
    from tallywing.sources.sinks import write_csv

    data, at = str(tmp_path / "data"), lambda name: str(tmp_path / name)
    write_csv(raw, data)
    (tmp_path / "cities.json").write_text('[{"id": 1, "name": "Oslo", "country_name": "Norway"}]')
    (tmp_path / "countries.json").write_text(
        '[{"id": 1, "name": "Norway", "iso3": "NOR", "latitude": "62", "longitude": "10", "timezones": [], "translations": {}}]'
    )
    (tmp_path / "codes.tsv").write_text("NOR\tNorway\nFRA\tFrance\n")
    cleaned = jobs.clean_job(spark, data, at("cleaned"))
    with monkeypatch.context() as patched:
        patched.setattr(jobs, "clean_feedback", None)  # the same files and options: nothing is built
        assert rows(cleaned) == rows(jobs.clean_job(spark, data, at("cleaned")))
        with pytest.raises(TypeError):
            jobs.clean_job(spark, data, at("cleaned"), fill=False)
    jobs.reasons_job(cleaned, at("reasons"))
    assert sorted(r[0] for r in spark.read.text(at("reasons")).collect()) == ["United\tLate_4", "United\tLost_1"]
    resolved = jobs.countries_job(spark, cleaned, at("cities.json"), at("countries.json"), at("resolved"))
    assert rows(resolved, "_id", "iso3") == [(4, "NOR")]
    jobs.top_countries_job(spark, resolved, at("codes.tsv"), 5, "negative", at("top"))
    assert [r[0] for r in spark.read.text(at("top")).collect()] == ["Norway\t1"]
    jobs.trust_job(cleaned, at("trust"))
    assert rows(spark.read.csv(at("trust"), header=True)) == [("app", "1.0", "1.0"), ("web", "0.5", "0.5")]
    lexicon = table([("good", "a", 1.0, 0.0)], "word string, pos string, pos_score double, neg_score double")
    accuracy = jobs.sentiment_job(spark, data, at("classified"), at("accuracy"), lexicon)
    assert ("sentiment", 1, 2, 50.0) in rows(accuracy)
    jobs.report_job(cleaned, resolved, read_countries(spark, at("countries.json")), at("reports"))
    assert spark.read.csv(at("reports/airline_profile"), header=True).first()["top_reasons"] == "Late|Lost"
    assert len(list((tmp_path / "reports").iterdir())) == 6


def test_cleaning_options(spark, raw, rows):
    """Other keys, NULL markers, the zone of all rows, mean retweets and the trusted reason's line breaks."""
    marked = raw.withColumn("user_timezone", F.when(F.col("_id") % 2 == 0, "NULL").otherwise("Oslo")).withColumn("retweet_count", F.when(F.col("_id") > 2, 4))
    marked = marked.withColumn("negativereason_gold", F.lit("a\nb\r\tc"))
    kept = clean_feedback(marked, drop=[], dedup_keys=["_id"], null_columns=["user_timezone"], zone_by=None, mean_retweets=True, reason_break=",")
    assert kept.count() == raw.select("_id").distinct().count()
    assert [r[0] for r in kept.select("user_timezone").distinct().collect()] == ["Oslo"]
    assert {r[0] for r in kept.select("retweet_count").distinct().collect()} == {4.0}
    assert {r[0] for r in kept.select("negativereason_gold").distinct().collect()} == {"a,b,,c"}
    plain = clean_feedback(marked, drop=[], dedup_keys=["_id"])
    assert "NULL" in {r[0] for r in plain.select("user_timezone").distinct().collect()}
    watch = {}
    clean_feedback(marked, watch=watch, null_columns=["user_timezone"]).write.format("noop").mode("overwrite").save()
    assert watch["read"].get["rows"] == raw.count() and watch["kept"].get["rows"] <= raw.count() and watch["filled"].get["zones"] > 0
