"""The six tasks from files to files; each reads, runs one plan and writes.

Tables between the tasks are Parquet, so types and columns survive; the results people read are CSV
or tab-separated text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywing.operators.cleaning import require_columns
from tallywing.operators.sentiment import vocabulary
from tallywing.plans import reports
from tallywing.plans.clean import clean_feedback
from tallywing.plans.countries import resolve_countries, top_countries
from tallywing.plans.reasons import render_reasons, top_reasons
from tallywing.plans.sentiment import classifier_accuracy, classify_feedback
from tallywing.plans.trust import trust_by_channel
from tallywing.sources.files import read_cities, read_countries, read_country_codes, read_feedback
from tallywing.sources.sinks import materialize, write_csv, write_key_value, write_parquet


def clean_job(spark: SparkSession, data_dir: str, out: str, **options) -> DataFrame:
    """Raw CSV folder to the cleaned table at ``out``, built only when the files or the options are others than last time."""
    return materialize(spark, out, lambda: clean_feedback(read_feedback(spark, data_dir), **options), [data_dir], options)


def reasons_job(cleaned: DataFrame, out: str, n: int = 5) -> None:
    """``airline <tab> reason_count`` lines."""
    write_key_value(render_reasons(top_reasons(cleaned, n=n)), "airline", "reason_count", path=out)


def countries_job(spark: SparkSession, cleaned: DataFrame, cities: str, countries: str, out: str) -> DataFrame:
    """Cleaned rows with ``iso3`` at ``out``."""
    resolved = resolve_countries(cleaned, read_cities(spark, cities), read_countries(spark, countries))
    write_parquet(resolved, out)
    return spark.read.parquet(out)


def top_countries_job(spark: SparkSession, resolved: DataFrame, codes: str, n: int, sentiment: str, out: str) -> None:
    """``country <tab> count`` lines, most first."""
    require_columns(resolved, ["airline_sentiment", "iso3"])
    top = top_countries(resolved, read_country_codes(spark, codes), n, sentiment)
    write_key_value(top, "country", "n", path=out)


def trust_job(cleaned: DataFrame, out: str, approximate: bool = False) -> None:
    write_csv(trust_by_channel(cleaned, approximate=approximate), out)


def sentiment_job(
    spark: SparkSession,
    data_dir: str,
    out: str,
    accuracy_out: str,
    lexicon: DataFrame,
    stop_words: DataFrame | None = None,
    valences: DataFrame | None = None,
) -> DataFrame:
    """Classified rows at ``out`` and one accuracy line per classifier; returns the latter."""
    vocab = vocabulary(lexicon, stop_words, valences)
    write_parquet(classify_feedback(read_feedback(spark, data_dir), vocab), out)
    write_csv(classifier_accuracy(spark.read.parquet(out)), accuracy_out)
    return spark.read.csv(accuracy_out, header=True, schema="classifier string, matches bigint, total bigint, accuracy double")


def report_job(cleaned: DataFrame, resolved: DataFrame, countries: DataFrame, out: str) -> None:
    """The tables behind the charts, one folder each below ``out``."""
    by_airline = cleaned.filter(~F.col("airline").isin("NULL"))
    tables = {
        "sentiment_by_channel": reports.sentiment_counts(cleaned, "_channel"),
        "positive_share_by_airline": reports.sentiment_share(by_airline, "airline"),
        "daily_sentiment": reports.daily_pivot(cleaned),
        "negative_by_country": reports.country_heat(resolved, countries),
        "retweets_by_airline": reports.totals(by_airline, name="total_retweets"),
    }
    for name, report in tables.items():
        write_csv(report, f"{out}/{name}")
    profile = reports.group_profile(by_airline.filter(F.col("negativereason1") != "Unknown"))
    write_csv(profile.withColumn("top_reasons", F.concat_ws("|", "top_reasons")), f"{out}/airline_profile")
