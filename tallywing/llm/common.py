"""What several corpus operators share: words, row identity, and writing and measuring summaries."""

from __future__ import annotations

import gc

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywing.session import scratch_path

#: Bytes of a table in a broadcast's hash table, counted as its fixed columns and 40 a row, and its texts.
BROADCAST_BYTES = 64 << 20
#: Bytes of rows that a Python worker gets at once.
BATCH_BYTES = 4 << 20


def words(text: str) -> str:
    """SQL: the words of a text column, split at blanks; null gives none."""
    return f"filter(split(coalesce({text}, ''), '[ \\\\t-\\\\r]+'), w -> w != '')"


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Key of a document: its id and a hash of its text.

    Rows that agree in both are the same document repeated and get the same answer; an id that
    stands on different texts, or a null id, does not mix up rows.
    """
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\0")), F.coalesce(F.col(text_col), F.lit("\0")))


def small(df: DataFrame, name: str) -> DataFrame:
    """Write a summary to the shared folder and read it back.

    The files tell Spark the size, so a later join broadcasts it only below Spark's own bound and
    shuffles beyond it; a lost executor does not repeat the work behind it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.staged_path = path
    return out


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Mark a written table for broadcast when it was counted to have at most ``rows`` rows and to fit 64 MB.

    Beyond that the join stays a shuffled one with the same result. Many small files would make Spark's
    own estimate from file sizes too large.
    """
    width = 40 + 8 * len(df.columns)
    texts = [F.octet_length(f.name) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    size = F.coalesce(F.sum(sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(width))), F.lit(0))
    n, held = df.agg(F.count("*"), size).first()
    return F.broadcast(df) if n <= rows and held <= BROADCAST_BYTES else df


def as_array(df: DataFrame, column: str) -> Broadcast | None:
    """A written table's whole numbers as one sorted array for all tasks, or None beyond ``BROADCAST_BYTES``."""
    if 8 * df.count() > BROADCAST_BYTES:
        return None
    return df.sparkSession.sparkContext.broadcast(np.sort(df.select(column).toArrow()[column].to_numpy()))


def within(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def short_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in batches of ``BATCH_BYTES``, unless the session names a size of its own.

    A batch of texts stands in the executor's buffers and in the worker, there as Arrow and as objects; Spark's default
    is 64 MB a task. The session keeps the setting. It changes how many rows come at once, never rows.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release(*tables: DataFrame) -> None:
    """Delete staged tables once all that was derived from them is written itself.

    Shuffle files go when Spark sees that no plan needs them; the collection asked for here lets it see that.
    """
    for table in tables:
        path = getattr(table, "staged_path", None)
        if path:
            at = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
    if tables:
        gc.collect()
        tables[0].sparkSession._jvm.System.gc()


def free(df: DataFrame, *names: str) -> list[str]:
    """Names like those asked for that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
