from datetime import datetime

from pyspark.sql import functions as F

from tallywing.constants import TWEET_TIME_FORMATS, WORK_TIME_FORMATS
from tallywing.functions import text as T
from tallywing.functions.geo import coordinates, is_finite
from tallywing.functions.timestamps import parse_minute
from tallywing.functions.values import label_by_threshold, marker_to_null, override, same_value
from tallywing.operators.sentiment import lexicon_pos


def one(table, value, expression, kind="string"):
    return table([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


def test_work_times_in_all_layouts(table):
    df = table([("2/25/2015 05:41:03",), ("12/25/2015 05:41:03",), ("2/5/2015 5:41",), ("bad",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_minute(F.col("t"), WORK_TIME_FORMATS)).collect()]
    assert got == [datetime(2015, 2, 25, 5, 41), datetime(2015, 12, 25, 5, 41), datetime(2015, 2, 5, 5, 41), None, None]


def test_tweet_times_put_the_day_first(table):
    assert one(table, "3/2/2015 9:05", lambda c: parse_minute(c, TWEET_TIME_FORMATS)) == datetime(2015, 2, 3, 9, 5)


def test_split_items_at_every_separator(table):
    df = table([("a\r\nb",), ("a&b",), ("a\nb ",), ("a",), (None,)], "v string")
    got = [tuple(r) for r in df.select(*T.split_items(F.col("v"))).collect()]
    assert got == [("a", "b"), ("a", "b"), ("a", "b"), ("a", None), (None, None)]


def test_coordinates_from_field_or_text(table):
    df = table(
        [("40.7,-73.9", None), ("[40.7, -73.9]", None), (None, "ÜT: 40.7,-73.9"), (None, "New York, NY"), (None, None),
         ("broken", "1.0,2.0"), (None, "+5, -6.25 here")],
        "coord string, place string",
    )
    got = [tuple(r) for r in df.select(*coordinates(F.col("coord"), F.col("place"))).collect()]
    assert got == [(40.7, -73.9)] * 3 + [(None, None)] * 3 + [(5.0, -6.25)]


def test_control_characters_and_quotes(table):
    assert one(table, 'a\n"b"\tc\rd', lambda c: T.single_quotes(T.replace_control(c))) == "a'b'cd"
    assert one(table, "a\nb\tc", lambda c: T.replace_control(c, " ")) == "a b c"


def test_composite_key_splits_at_the_first_underscore(table):
    df = table([("x_y_z",), ("x",)], "k string")
    assert [tuple(r) for r in df.select(*T.split_composite_key(F.col("k"))).collect()] == [("x", "y_z"), ("x", None)]


def test_before_comma_and_words(table):
    assert one(table, "Rome, Italy", T.before_comma) == "Rome"
    assert one(table, "Don't PANIC, ok?!", T.words) == ["don't", "panic", "ok"]
    assert one(table, "", T.words) == []


def test_top_of_lists_keeps_pairs_and_orders_ties(table):
    df = table([(["b", "a", "c"], [2, 2, 5])], "v array<string>, n array<int>")
    assert df.select(T.top_of_lists(F.col("v"), F.col("n"), 2)).first()[0] == ["c", "a"]


def test_override_and_markers(table):
    df = table([("negative", None), ("positive", "neutral"), (None, None)], "label string, gold string")
    assert [r[0] for r in df.select(override(F.col("gold"), F.col("label"))).collect()] == ["negative", "neutral", None]
    assert [r[0] for r in df.select(same_value(F.col("gold"), F.col("label"))).collect()] == [0, 0, 0]
    assert one(table, "NULL", marker_to_null) is None
    assert one(table, "x", marker_to_null) == "x"


def test_labels_on_the_edges(table):
    for threshold in (0.1, 0.2, 0.05):
        df = table([(threshold,), (-threshold,), (0.0,), (None,)], "s double")
        got = [r[0] for r in df.select(label_by_threshold(F.col("s"), threshold)).collect()]
        assert got == ["positive", "negative", "neutral", None]


def test_finite(table):
    df = table([(1.0,), (float("nan"),), (float("-inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(is_finite(F.col("v"))).collect()] == [True, False, False, False]


def test_treebank_tags(table):
    df = table([("JJR",), ("VBD",), ("NNS",), ("RB",), ("DT",), (None,)], "t string")
    assert [r[0] for r in df.select(lexicon_pos(F.col("t"))).collect()] == ["a", "v", "n", "r", None, None]
