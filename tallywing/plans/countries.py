"""Resolve feedback to countries, and rank countries by one sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.constants import COUNTRY_REACH
from tallywing.functions.geo import coordinates
from tallywing.functions.text import before_comma
from tallywing.operators.filters import equals_ignoring_case, in_domain
from tallywing.operators.joins import first_per_key, join_lookup, nearest_within
from tallywing.operators.ranking import counts
from tallywing.session import settle


def city_codes(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """(city, code): the country code of each city name; of equal names the smallest id."""
    named = first_per_key(cities.select("id", "name", "country_name"), "name", "id")
    codes = first_per_key(countries.select("id", "name", "iso3"), "name", "id").filter(F.col("iso3").isNotNull())
    return named.select(F.col("name").alias("city"), F.col("country_name")).join(
        codes.select(F.col("name").alias("country_name"), F.col("iso3").alias("code")), "country_name"
    ).select("city", "code")


def locate(df: DataFrame, coord: str = "tweet_coord", location: str = "tweet_location") -> DataFrame:
    """Add latitude and longitude, null where the row has none."""
    latitude, longitude = coordinates(F.col(coord), F.col(location))
    return df.withColumns({"latitude": latitude, "longitude": longitude})


def resolve_countries(
    df: DataFrame,
    cities: DataFrame,
    countries: DataFrame,
    reach: float = COUNTRY_REACH,
    coord: str = "tweet_coord",
    location: str = "tweet_location",
) -> DataFrame:
    """Add ``iso3``: the nearest country within ``reach``, else the country of the city named.

    Rows resolved by neither are dropped, as are the location columns. Both steps are lookups from
    the same rows, so the table is neither collected nor joined back to itself.
    """
    targets = countries.select(F.col("id").alias("_country_id"), "latitude", "longitude", "iso3")
    near = nearest_within(
        locate(df, coord, location), targets, reach, target_id="_country_id", keep=["iso3"], how="left"
    )
    city = F.when(F.col("iso3").isNull(), before_comma(F.col(location)))
    # Rows with a country have no city here, and null keys take no part in the join's shuffle.
    both = join_lookup(near.withColumn("city", city), settle(city_codes(cities, countries)), "city", "left")
    return (
        both.withColumn("iso3", F.coalesce("iso3", "code"))
        .filter(F.col("iso3").isNotNull())
        .select(*[c for c in df.columns if c not in (coord, location)], "iso3")
    )


def top_countries(
    df: DataFrame,
    codes: DataFrame,
    n: int,
    sentiment: str,
    label: str = "airline_sentiment",
    code: str = "iso3",
) -> DataFrame:
    """(country, n) for one sentiment, most first, ties by name; ``n = -1`` gives all.

    Counted per code before the lookup, so a country with most of the rows is one row in the join.
    """
    if n < -1:
        raise ValueError("n must be -1 (all) or at least 0")
    rows = equals_ignoring_case(in_domain(df, label), label, sentiment)
    tally = counts(rows, code).withColumnRenamed(code, "code")
    named = join_lookup(tally, codes, "code", "inner").groupBy(F.col("name").alias("country")).agg(F.sum("n").alias("n"))
    ranked = named.orderBy(F.desc("n"), F.asc("country"))
    return ranked if n == -1 else ranked.limit(n)
