import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from driver_queries import files as queries, registry
from tallywing.sources import files, headers, sinks
from tallywing.sources.schemas import RAW_SCHEMA

SMALL = "id bigint, text string, n int"


def test_quoted_fields_and_combined_file(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n\n1,"a, b",1\n2,"line\r\nbreak ""q""",2\n', newline="")
    (tmp_path / "b.csv").write_text("id,text,n\n3,,3\n")
    (tmp_path / "combined_csv.csv").write_text("id,text,n\n9,all,9\n")
    (tmp_path / "notes.txt").write_text("not a table")
    df = files.read_feedback(spark, str(tmp_path), SMALL, file_column="file_name")
    assert rows(df, "id", "text", "n") == [(1, "a, b", 1), (2, 'line\r\nbreak "q"', 2), (3, None, 3)]
    assert rows(files.rows_per_file(df)) == [("a.csv", 2), ("b.csv", 1)]


def headed(tmp_path):
    (tmp_path / "a.csv").write_text("id,text,n\n1,x,10\n")
    (tmp_path / "b.csv").write_text("n,TEXT,Id\n20,y,2\n")
    (tmp_path / "c.csv").write_bytes('\ufeffextra,"n",text,"id",more\r\n"p, q",30,"z\nz",3,\r\n'.encode())
    (tmp_path / "d.csv").write_text('"two\nlines",id,n,text,id\n0,4,40,w,99\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "combined_csv.csv").write_text("no,such,columns\n1,2,3\n")


HEADED = [(1, "x", 10), (2, "y", 20), (3, "z\nz", 30), (4, "w", 40)]


@pytest.mark.parametrize("apart", [True, False])
def test_columns_are_found_by_name(spark, rows, tmp_path, monkeypatch, apart):
    """Swapped, mixed-case, quoted, extra and repeated names; files that share a task give the same."""
    headed(tmp_path)
    if not apart:
        monkeypatch.setattr(type(spark.conf), "set", lambda self, key, value: None)
    groups = headers.read_headers(spark, str(tmp_path), skip=[files.COMBINED_FILE])
    assert [(g.names, len(g.files)) for g in groups] == [
        (("id", "text", "n"), 1), (("n", "TEXT", "Id"), 1), (("extra", "n", "text", "id", "more"), 1), (("two\nlines", "id", "n", "text", "id"), 1)]
    assert rows(files.read_feedback(spark, str(tmp_path), SMALL)) == HEADED


def test_columns_are_found_by_name_in_other_readers(spark, rows, tmp_path):
    headed(tmp_path)
    (tmp_path / "combined_csv.csv").unlink()
    assert rows(files.read_typed(spark, str(tmp_path), SMALL)) == HEADED
    assert rows(files.read_mixed_encodings(spark, str(tmp_path), SMALL)) == HEADED


@pytest.mark.parametrize("corrupt", [None, "_bad"])
def test_missing_names_are_an_error_that_names_the_file(spark, tmp_path, corrupt):
    (tmp_path / "a.csv").write_text("id,text,n\n1,x,2\n")
    (tmp_path / "b.csv").write_text("b,text,id\n1,x,2\n")
    with pytest.raises(ValueError, match=r"missing columns \['n'\].*b\.csv"):
        files.read_feedback(spark, str(tmp_path), SMALL, corrupt_column=corrupt)


def test_bad_rows_with_swapped_headers(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("n,text,id\n1,x,10\nmany,y,20\n3,z\n")
    df = files.read_feedback(spark, str(tmp_path), SMALL, corrupt_column="_bad").cache()
    assert rows(files.valid_rows(df, "_bad")) == [(10, "x", 1)]
    assert rows(df.filter("_bad is not null"), "_bad") == [("3,z",), ("many,y,20",)]


def test_one_header_is_one_scan(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"text,id,n\nx,{i},1\n")
    df = files.read_feedback(spark, str(tmp_path), SMALL)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and df.count() == 5


def test_a_folder_without_files_is_empty(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    df = files.read_feedback(spark, str(tmp_path), SMALL, corrupt_column="_bad", file_column="f")
    assert df.columns == ["id", "text", "n", "_bad", "f"] and df.count() == 0


def test_rows_that_do_not_fit_are_reported(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n\n1,"x, y",1\n2,short\n3,z,many\n4,ok,4\n')
    df = files.read_feedback(spark, str(tmp_path), SMALL, corrupt_column="_bad").cache()
    assert rows(files.valid_rows(df, "_bad")) == [(1, "x, y", 1), (4, "ok", 4)]
    assert rows(df.filter(F.col("_bad").isNotNull()), "_bad") == [("2,short",), ("3,z,many",)]


def test_raw_schema_has_27_columns(spark):
    assert len(spark.createDataFrame([], RAW_SCHEMA).columns) == 27


def test_encodings_are_decided_per_file(spark, rows, tmp_path):
    (tmp_path / "utf.csv").write_bytes("id,text\n1,café\n2,日本\n".encode("utf-8"))
    # A valid UTF-8 line inside an ISO-8859-1 file stays what that file's encoding says.
    (tmp_path / "latin.csv").write_bytes("id,text\n3,café\n4,cafÃ©\n".encode("iso-8859-1"))
    df = files.read_mixed_encodings(spark, str(tmp_path), "id int, text string")
    assert rows(df) == [(1, "café"), (2, "日本"), (3, "café"), (4, "cafÃ©")]


def test_lookup_files(spark, rows, tmp_path):
    (tmp_path / "codes.tsv").write_text("BES\tBonaire, Saint Eustatius and Saba\nNOR\tNorway\n")
    assert rows(files.read_country_codes(spark, str(tmp_path / "codes.tsv"))) == [
        ("BES", "Bonaire, Saint Eustatius and Saba"), ("NOR", "Norway")
    ]
    country = {"id": 1, "name": "Norway", "iso3": "NOR", "latitude": "62.0", "longitude": "", "timezones": [{"z": 1}], "translations": {"a": "b"}}
    (tmp_path / "countries.json").write_text(json.dumps([country], indent=1))
    assert rows(files.read_countries(spark, str(tmp_path / "countries.json"))) == [(1, "Norway", "NOR", 62.0, None)]
    (tmp_path / "cities.json").write_text(json.dumps([{"id": 5, "name": "Oslo", "country_name": "Norway", "wikiDataId": "Q"}]))
    assert rows(files.read_cities(spark, str(tmp_path / "cities.json"))) == [(5, "Oslo", "Norway")]


def test_missing_input_says_what_to_supply(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="cities"):
        files.read_cities(spark, str(tmp_path / "no.json"))
    with pytest.raises(FileNotFoundError, match="feedback CSV"):
        files.read_feedback(spark, str(tmp_path / "none"))


def test_typed_inferred_and_string_reads(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n1,2/25/2015 05:41:03\n")
    path = str(tmp_path)
    assert files.read_typed(spark, path, "id int, t timestamp").first()["t"].isoformat() == "2015-02-25T05:41:03"
    assert files.read_inferred(spark, path).dtypes[0] == ("id", "int")
    assert files.read_strings(spark, path).dtypes == [("id", "string"), ("t", "string")]


def test_csv_round_trip_and_replace(spark, table, rows, tmp_path):
    path = str(tmp_path / "out")
    df = table([(1, ' padded "q"\n', None), (2, "", 5)], SMALL)
    sinks.write_csv(table([(7, "old", 7)], SMALL), path)
    sinks.write_csv(df, path, single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    # CSV has one spelling for null and the empty text; it reads back as null.
    assert rows(files.read_feedback(spark, path, SMALL)) == [(1, ' padded "q"\n', None), (2, None, 5)]


def test_key_value_lines(spark, table, tmp_path):
    path = str(tmp_path / "kv")
    sinks.write_key_value(table([("A", "Late", 3)], "k string, r string, n int"), "k", "r", "n", path=path)
    assert [r[0] for r in spark.read.text(path).collect()] == ["A\tLate_3"]


def test_materialize_builds_once_and_again_after_an_unfinished_write(spark, table, rows, tmp_path):
    path = tmp_path / "table"
    path.mkdir()
    (path / "part-left-over.parquet").write_text("not finished")
    built = []

    def build():
        built.append(1)
        return table([(1,)], "i int")

    assert rows(sinks.materialize(spark, str(path), build)) == [(1,)]
    assert rows(sinks.materialize(spark, str(path), build)) == [(1,)]
    assert built == [1]


def test_materialize_follows_options_inputs_and_schema(spark, table, rows, tmp_path):
    path, source = str(tmp_path / "table"), tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("1")
    built = []

    def build(value):
        def run():
            built.append(value)
            return table([(value,)], "i int")
        return run

    def call(value, **options):
        return rows(sinks.materialize(spark, path, build(value), [str(source)], options))

    assert call(1, a=1) == [(1,)] and call(2, a=1) == [(1,)] and built == [1]
    assert call(3, a=2) == [(3,)] and call(4, a=2) == [(3,)]
    (source / "b.csv").write_text("2")
    assert call(5, a=2) == [(5,)]
    table([(9, 9)], "i int, j int").write.mode("overwrite").parquet(str(tmp_path / "other"))
    for part in (tmp_path / "table").glob("*.parquet"):
        part.unlink()
    for part in (tmp_path / "other").glob("*.parquet"):
        part.rename(tmp_path / "table" / part.name)
    assert call(6, a=2) == [(6,)]
    assert not list(tmp_path.glob(".table*"))


def test_a_failed_build_keeps_the_former_table(spark, table, rows, tmp_path):
    path = str(tmp_path / "table")
    sinks.materialize(spark, path, lambda: table([(1,)], "i int"), options={"a": 1})
    broken = table([(1,)], "i int").select(F.raise_error(F.lit("lost")).alias("i"))
    with pytest.raises(Exception, match="lost"):
        sinks.materialize(spark, path, lambda: broken, options={"a": 2})
    assert rows(spark.read.parquet(path)) == [(1,)]


@pytest.mark.parametrize("write", [sinks.write_parquet, sinks.write_csv])
def test_a_failed_write_keeps_the_former_table(spark, table, rows, tmp_path, write):
    path = str(tmp_path / "out")
    assert write(table([(1, "a"), (2, "b")], "i int, t string"), path) == 2
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    broken = table([(i, "x") for i in range(20)], "i int, t string").repartition(4).withColumn(
        "t", F.when(F.col("i") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("t")))
    with pytest.raises(Exception, match="lost"):
        write(broken, path)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    assert write(table([(3, "c")], "i int, t string"), path) == 1
    read = spark.read.option("header", True).csv if write is sinks.write_csv else spark.read.parquet
    assert [r.t for r in read(path).collect()] == ["c"]


def test_a_table_may_be_replaced_by_its_own_rows(spark, table, rows, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(table([(1,), (2,)], "i int"), path)
    sinks.write_parquet(spark.read.parquet(path).filter("i > 1"), path)
    assert rows(spark.read.parquet(path)) == [(2,)]


def test_a_cut_off_switch_is_put_back(spark, table, rows, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(table([(1,)], "i int"), path)
    (tmp_path / "out").rename(tmp_path / ".out.former")
    assert sinks.recover(spark, path) and rows(spark.read.parquet(path)) == [(1,)]
    assert not sinks.recover(spark, path)


def test_observed_counts(spark, table, tmp_path):
    seen, watch = sinks.observed(table([(1,), (None,)], "i int"), known=F.count("i"), rows=F.count(F.lit(1)))
    assert sinks.write_parquet(seen, str(tmp_path / "out")) == 2
    assert watch.get == {"known": 1, "rows": 2}
    assert sinks.write_parquet(table([], "i int"), str(tmp_path / "none")) == 0


def test_reports_to_the_driver_are_bounded(table):
    df = table([(i,) for i in range(5)], "i int")
    assert len(sinks.report_frame(df, max_rows=5)) == 5
    with pytest.raises(ValueError, match="more than 4"):
        sinks.report_frame(df, max_rows=4)
    assert sinks.preview(df, 2).count() == 2


def test_files_of_a_large_table_are_many_not_large(spark, rows, tmp_path, monkeypatch):
    """The CSV queries leave each task's rows in files of its own: no file, the combined one either, holds the table."""
    docs = [(i, f'text, {i} "q"\n' * 20 + ("ä" if i % 3 else "ж"), "en", "web", 100) for i in range(200)]
    made = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    made.repartition(8, "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 200, 4)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, paths = queries.scratch_path, []

    def watched(spark, name):
        paths.append(kept(spark, name))
        return paths[-1]

    monkeypatch.setattr(queries, "scratch_path", watched)
    counts, all_rows, texts = (rows(registry.QUERIES[n](spark, str(tmp_path))) for n in ("csv_rows_per_file", "csv_headers", "csv_mixed_encodings"))
    assert counts == [(f"f{i}.csv", 80) for i in range(5)] and sorted(r[0] for r in all_rows) == list(range(400))
    assert texts == sorted((i, hashlib.sha256(t.encode()).hexdigest(), "en") for i, t, *_ in docs)
    for path in (p for p in paths if "parts-" not in p):
        sizes = [f.stat().st_size for f in Path(path).rglob("combined_csv.csv")]
        assert len(sizes) > 2 and max(sizes) < sum(sizes) / 2
