"""Schemas of the feedback files, as the files are laid out."""

from __future__ import annotations

# The 27 raw columns in file order. Ids are wide enough to keep every digit.
RAW_SCHEMA = """
    _unit_id bigint, _created_at string, _golden boolean, _id bigint, _missed boolean,
    _started_at string, _tainted boolean, _channel string, _trust double, _worker_id bigint,
    _country string, _region string, _city string, _ip string,
    airline_sentiment string, negativereason string, airline string,
    airline_sentiment_gold string, name string, negativereason_gold string,
    retweet_count bigint, text string, tweet_coord string, tweet_created string,
    tweet_id bigint, tweet_location string, user_timezone string
"""

# The 26 columns of a cleaned file read back with typed timestamps.
TYPED_SCHEMA = """
    _unit_id bigint, _created_at timestamp, _golden boolean, _id bigint, _missed boolean,
    _started_at timestamp, _tainted boolean, _channel string, _trust double, _worker_id bigint,
    _country string, _ip string, airline_sentiment string, negativereason string, airline string,
    airline_sentiment_gold string, name string, negativereason_gold string,
    retweet_count bigint, text string, tweet_created timestamp, tweet_id bigint,
    user_timezone string, negativereason1 string, negativereason2 string, sentiment string
"""

# Lookup tables.
CODES_SCHEMA = "code string, name string"
CITIES_SCHEMA = "id bigint, name string, country_name string"
COUNTRIES_SCHEMA = "id bigint, name string, iso3 string, latitude string, longitude string"
