"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "tallywing", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; anything in ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session (tests) gets a temporary folder when the setting is missing; on a cluster
    a machine-local folder would lose data with its machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tallywing-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from the written rows.

    Used for small summaries that are needed twice (to measure them, then to join them), so the
    large table behind them is not scanned again. Lost executors do not lose the rows.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a scanned table by ``keys`` when its files give fewer tasks than there are cores.

    For work that costs much more than reading, on tables that are few or small files. A large table
    has more tasks than cores and stays as it is. Meant for plain scans: asking another plan for its
    number of tasks may run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a large intermediate as Parquet into the shared folder and read it back.

    For a table that two later steps need: each reads only its own columns, and neither repeats the
    shuffle behind it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_by_task(df: DataFrame, name: str, task: str, row: str) -> DataFrame:
    """Write ``df`` with two new key columns, bucketed by the first, without moving a row.

    ``task`` is the number of the task that wrote the row and ``row`` its number there. All rows of a task go to one
    bucket, so tables that are derived from this one by (``task``, ``row``) and grouped by it come without a shuffle, and
    so does their join back to it. The table stands in the shared folder under a name of its own in the session's
    catalog.

    The session is told to accept, in joins too, a partitioning by some of the keys; Spark's default asks for all of
    them and would move both sides. That changes plans, never rows.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    number = F.monotonically_increasing_id()
    marked = df.select("*", F.shiftright(number, 33).cast("int").alias(task), number.bitwiseAND(F.lit((1 << 33) - 1)).alias(row))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{re.sub('[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    marked.write.format("parquet").bucketBy(buckets, task).option("path", path).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    out.staged_path = path
    return out
