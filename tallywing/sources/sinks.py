"""Writers, build-if-changed tables, and bringing small results to the driver.

A writer never deletes the table it replaces before the new one is complete: it writes beside it, then renames. A job
that fails leaves the former table as it was. Two renames make the switch; between them the former table stands under
its spare name, from which the next write or :func:`recover` puts it back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

import pandas as pd
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallywing.functions.text import composite_key

REPORT_ROWS = 100_000
MANIFEST = "_manifest.json"


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop's file system of a path, and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _beside(spark: SparkSession, path: str, mark: str) -> JavaObject:
    _, at = _files(spark, path)
    return spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{mark}")


def _rename(files: JavaObject, old: JavaObject, new: JavaObject) -> None:
    if not files.rename(old, new):
        raise OSError(f"could not rename {old} to {new}")


def recover(spark: SparkSession, path: str) -> bool:
    """Put the former table back where a switch was cut off between its two renames; tells whether it did."""
    files, at = _files(spark, path)
    spare = _beside(spark, path, "former")
    if files.exists(at) or not files.exists(spare):
        return False
    _rename(files, spare, at)
    return True


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Call ``write`` with a path beside ``path``, and put the finished result in the place of what was there.

    Meant for one writer at a time, as any replaced table is.
    """
    files, at = _files(spark, path)
    recover(spark, path)
    new, spare = _beside(spark, path, f"new-{uuid.uuid4().hex}"), _beside(spark, path, "former")
    try:
        write(new.toString())
    except BaseException:
        files.delete(new, True)
        raise
    if files.exists(spare):
        files.delete(spare, True)
    if files.exists(at):
        _rename(files, at, spare)
    _rename(files, new, at)
    files.delete(spare, True)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` and metrics gathered in the pass that computes it; ``get`` on the second waits for that pass.

    Without metrics the rows are counted. A task that ran again counts once; a map stage that had to be
    repeated after an executor was lost may count its rows again, so use these numbers for reports, not for results.
    """
    seen = Observation()
    return df.observe(seen, *[m.alias(n) for n, m in (metrics or {"rows": F.count(F.lit(1))}).items()]), seen


CSV_OUT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """CSV with header, replacing what is there; one file only on request. Returns the rows written."""
    out, seen = observed(df.coalesce(1) if single_file else df)
    replace(df.sparkSession, path, lambda to: out.write.options(**CSV_OUT).csv(to))
    return seen.get["rows"]


def write_parquet(df: DataFrame, path: str) -> int:
    """Parquet, replacing what is there. Returns the rows written."""
    out, seen = observed(df)
    replace(df.sparkSession, path, lambda to: out.write.parquet(to))
    return seen.get["rows"]


def write_key_value(df: DataFrame, key: str, *parts: str, path: str) -> int:
    """Lines of ``key <tab> value``; several parts are joined by ``_``. Returns the lines written.

    A null key is written empty. Tabs, line breaks and backslashes inside are written ``\\t``, ``\\n``,
    ``\\r`` and ``\\\\``, so every row is one line of two fields.
    """

    def escaped(text: Column) -> Column:
        for raw, mark in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(raw), F.lit(mark))
        return text

    value = escaped(composite_key(*[F.col(p).cast("string") for p in parts]))
    line = F.concat(F.coalesce(escaped(F.col(key).cast("string")), F.lit("")), F.lit("\t"), value)
    out, seen = observed(df.select(line.alias("value")))
    replace(df.sparkSession, path, lambda to: out.write.text(to))
    return seen.get["rows"]


def input_state(spark: SparkSession, paths: Sequence[str]) -> dict[str, object]:
    """What the files below the paths look like: their number, bytes, latest time, and a hash of all names, lengths and times.

    The files are listed, not read.
    """
    if not paths:
        return {"files": 0, "bytes": 0, "latest": None, "hash": "0"}
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path", "length", "modificationTime")
    row = listed.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modificationTime").cast("string").alias("latest"),
        F.coalesce(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("hash")).first()
    return row.asDict()


def _manifest(spark: SparkSession, path: str) -> dict | None:
    files, at = _files(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path(at, MANIFEST)
    done = spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")
    if not (files.exists(place) and files.exists(done)):
        return None
    stream = files.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    except ValueError:
        return None  # cut off while it was written: the table counts as unfinished
    finally:
        stream.close()


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: Sequence[str] = (),
                options: dict[str, object] | None = None) -> DataFrame:
    """The Parquet table at ``path``, built when none is there that came from the same inputs and options.

    A manifest beside the data files holds the state of the inputs (names, lengths and times of all files below
    ``inputs``), the options as text and the table's schema. A table without a manifest, an unfinished one, and one
    whose manifest differs in any of these is built again; the former table stays until the new one is complete.
    """
    recover(spark, path)
    wanted = {"inputs": input_state(spark, inputs), "options": {k: repr(v) for k, v in sorted((options or {}).items())}}
    found = _manifest(spark, path)
    if found is not None and {k: found.get(k) for k in wanted} == wanted:
        table = spark.read.parquet(path)
        if json.loads(table.schema.json()) == found.get("schema"):
            return table
    built = build()

    def write(to: str) -> None:
        built.write.parquet(to)
        # As it reads back: Parquet makes every column nullable.
        text = json.dumps({**wanted, "schema": json.loads(spark.read.parquet(to).schema.json())}, default=str)
        files, at = _files(spark, to)
        stream = files.create(spark._jvm.org.apache.hadoop.fs.Path(at, MANIFEST))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    replace(spark, path, write)
    return spark.read.parquet(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def report_frame(df: DataFrame, max_rows: int = REPORT_ROWS) -> pd.DataFrame:
    """A finished report as pandas, for charts; refuses anything larger than ``max_rows``."""
    frame = df.limit(max_rows + 1).toPandas()
    if len(frame) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate before bringing a table to the driver")
    return frame
