"""Fillers, nulls, other scripts and separators inside values."""

from pyspark.sql import functions as F

from tallywing.functions.geo import coordinates
from tallywing.functions.text import words
from tallywing.operators import ranking
from tallywing.operators.cleaning import stable_key
from tallywing.operators.joins import first_per_key
from tallywing.sources import sinks


def test_fillers_are_no_coordinates(table):
    rows = [("[1.5, 2]", "3,4"), ("Unknown", "at 3.5,4.5"), ("NULL", "at 3.5,4.5"), (None, "at 3.5,4.5"), ("Unknown", None)]
    df = table(rows, "coord string, place string").select(*coordinates(F.col("coord"), F.col("place")))
    assert [tuple(r) for r in df.collect()] == [(1.5, 2.0), (3.5, 4.5), (3.5, 4.5), (3.5, 4.5), (None, None)]


def test_words_of_any_script(table):
    df = table([("Können wir über_it 東京 don't café",)], "t string")
    assert df.select(words(F.col("t"))).first()[0] == ["können", "wir", "über", "it", "東京", "don't", "café"]


def test_keys_of_different_rows_differ(table):
    rows = [("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), ("", ""), ("-", None), (None, None)]
    keys = table(rows, "x string, y string").select(stable_key(F.col("x"), F.col("y")))
    assert keys.distinct().count() == len(rows)


def test_null_reasons_take_no_place(table, rows):
    df = table([("x", None), ("x", None), ("x", "Late"), ("y", None)], "g string, v string")
    assert rows(ranking.top_lists(df, "g", "v", 2)) == [("x", ["Late"]), ("y", [])]


def test_lines_keep_their_two_fields(spark, table, tmp_path):
    df = table([(None, "r", 1), ("a\tb", "line\nbreak\\", 2)], "k string, r string, n int")
    sinks.write_key_value(df, "k", "r", "n", path=str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["\tr_1", "a\\tb\tline\\nbreak\\\\_2"]


def test_first_per_key_breaks_ties(table, rows):
    for data in ([("k", 1, "b"), ("k", 1, "a")], [("k", 1, "a"), ("k", 1, "b")]):
        assert rows(first_per_key(table(data, "k string, o int, v string"), "k", "o")) == [("k", 1, "a")]
