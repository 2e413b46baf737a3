"""CSV files whose columns stand in any order: names are resolved by each file's own header.

A metadata pass reads the first record of every file, each file in tasks of its own that stop there, and groups the
files by header. A table is then one scan per distinct header, with the columns asked for picked by name, and the
union of the scans. Files that agree on their header (the usual case) are still read in one scan.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tallywing.operators.naming import free

#: Lines that a header record may take, and what a task hands over at once.
HEADER_LINES = 64


@dataclass(frozen=True)
class HeaderGroup:
    """Files of one header, with the names as they are written."""

    names: tuple[str, ...]
    files: tuple[str, ...]


def _record(lines: Sequence[bytes], encoding: str) -> list[str] | None:
    """The first record of the lines, or None when its quotes are still open."""
    text = b"\n".join(lines).decode(encoding, "replace").removeprefix("﻿")
    if text.count('"') % 2:
        return None
    return next(csv.reader(io.StringIO(text, newline=""), quotechar='"', doublequote=True), None)


def read_headers(spark: SparkSession, path: str | list[str], pattern: str = "*.csv", skip: Sequence[str] = (),
                 encoding: str = "utf-8") -> list[HeaderGroup]:
    """Every distinct header below ``path`` with its files; empty files are left out.

    The result lists each file once, as Spark's own file index on the driver does.
    """
    apart = spark.newSession()
    # A file shares its task with no other, so the task can stop at the first record.
    whole, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    apart.conf.set(cost, apart.conf.get(whole))
    alone = apart.conf.get(cost) == apart.conf.get(whole)
    lines = apart.read.options(pathGlobFilter=pattern).text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"))
    if skip:
        lines = lines.filter(~F.col("name").isin(*skip))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        now = done = None
        for batch in batches:
            for line, file, start in zip(*(batch.column(c) for c in ("line", "file", "start"))):
                file = file.as_py()
                if file != now:
                    held, now = [], file
                if start.as_py() or file == done:
                    if alone:
                        return
                    continue
                held.append(line.as_py().removesuffix(b"\r"))
                names = _record(held, encoding)
                if names is not None:
                    done = file
                    names = [n.strip() for n in names]
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([names], type=pa.list_(pa.string()))], names=["file", "names"])
                elif len(held) >= HEADER_LINES:
                    raise ValueError(f"no header record within {HEADER_LINES} lines of {file}")

    found = lines.select("line", "file", "start").mapInArrow(first, "file string, names array<string>")
    grouped = found.groupBy("names").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted((HeaderGroup(tuple(r.names), tuple(r.files)) for r in grouped), key=lambda g: g.files)


def _positions(group: HeaderGroup, names: Sequence[str]) -> list[int]:
    """Where the header has each name, whatever its case; the first of equal ones counts."""
    at: dict[str, int] = {}
    for i, name in enumerate(group.names):
        at.setdefault(name.lower(), i)
    missing = [n for n in names if n.lower() not in at]
    if missing:
        raise ValueError(f"missing columns {missing} in the header {list(group.names)} of {group.files[0]}"
                         + (f" and {len(group.files) - 1} more files" if len(group.files) > 1 else ""))
    return [at[n.lower()] for n in names]


def read_by_header(spark: SparkSession, path: str | list[str], fields: StructType, options: dict, pattern: str = "*.csv",
                   skip: Sequence[str] = (), corrupt_column: str | None = None, file_column: str | None = None) -> DataFrame:
    """The columns of ``fields`` from all files, each found by its name; other columns of a file are not returned.

    A name that a header lacks is an error that names the file. With ``corrupt_column`` a row that does not fit its
    file's header or the types is kept there as text. ``file_column`` adds the name of the row's file.
    """
    groups = read_headers(spark, path, pattern, skip, options.get("encoding", "utf-8"))
    names = [f.name for f in fields]
    plans = [(g, _positions(g, names)) for g in groups]
    tables = []
    for group, positions in plans:
        wanted = dict(zip(positions, fields))
        layout, slots = StructType(), free([corrupt_column or ""], *(f"c{i}" for i in range(len(group.names))))
        for i, slot in enumerate(slots):
            layout = layout.add(slot, wanted[i].dataType if i in wanted else StringType())
        reader = spark.read.options(**{**options, "header": True})
        if corrupt_column:
            layout = layout.add(corrupt_column, StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("mode", "PERMISSIVE")
        # One header: the folder itself is scanned, so Spark lists it in parallel and files may be many.
        if len(plans) == 1:
            table = reader.options(pathGlobFilter=pattern).schema(layout).csv(path)
            table = table.filter(~F.col("_metadata.file_name").isin(*skip)) if skip else table
        else:
            table = reader.schema(layout).csv(list(group.files))
        columns = [F.col(slots[p]).alias(n) for p, n in zip(positions, names)]
        if corrupt_column:
            columns.append(F.col(corrupt_column))
        if file_column:
            columns.append(F.col("_metadata.file_name").alias(file_column))
        tables.append(table.select(*columns))
    if not tables:
        layout = StructType(list(fields))
        for name in (corrupt_column, file_column):
            layout = layout.add(name, StringType()) if name else layout
        return spark.createDataFrame([], layout)
    return reduce(DataFrame.union, tables)
