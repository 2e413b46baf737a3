"""Connected components of a link table, by joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import small


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (least node reachable) for every node of ``links`` (``a``, ``b``).

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its
    smaller ones, to the least node it sees. The number of rounds grows with the logarithm of the
    longest path. A node with very many neighbours is reduced on the map side and its links meet one
    row in a join that Spark can split; each round is written, so lost executors cost one round.
    """
    edges = small(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        # Larger neighbours: over both directions, link them to the least node of the neighbourhood.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Smaller neighbours and the node itself: link them to the least.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        down = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = small(down.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 1_000_033)).first())
        if after == before:
            break
        before = after
    labels = edges.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    return labels.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
