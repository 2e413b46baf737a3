"""Lookup joins beyond the broadcast bound: only keys measured to be hot are spread, and null keys stay where they are.

Hot keys come from a frequent-items summary that tasks build and Spark merges; its size is bounded whatever the number
of keys. A key is hot when it holds more rows than ``share`` of one shuffle partition's fair part; it gets as many
salts as its count fills fair parts. All other keys have one salt, so the lookup is repeated for hot keys alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.operators.naming import free
from tallywing.session import stage

#: Items that the summary holds, and those looked at. The count of an item is too large by at most 3.5 / ITEMS of the rows.
ITEMS, HOT = 4096, 256
MAX_SALTS = 4096


def _encoded(keys: Sequence[str]) -> Column:
    """One text for the key columns; the lengths keep different keys apart."""
    texts = [F.col(k).cast("string") for k in keys]
    return F.concat_ws("", *(F.concat(F.length(t), F.lit(":"), t) for t in texts))


def any_null(keys: Sequence[str]) -> Column:
    """Whether one of the key columns is null."""
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def heavy_hitters(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> dict[str, int]:
    """Encoded keys that hold more than a fair part of the rows, and how many fair parts they fill.

    Null keys are not counted, as they join nothing. At most ``HOT`` keys reach the driver.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = df.filter(~any_null(keys)).select(_encoded(keys).alias("key"))
    row = known.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k(key, {HOT}, {ITEMS})").alias("top")).first()
    fair = max(1, row.rows // parts)
    return {item.item: min(MAX_SALTS, -(-item["count"] // fair)) for item in row.top or [] if item["count"] > fair}


def _costly(df: DataFrame) -> bool:
    """Whether computing the table again takes more than a scan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(step in plan for step in ("Join", "Aggregate", "Window", "MapIn", "Generate", "Sort", "FlatMap"))


def salted_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str, hot: dict[str, int] | None = None,
                salt_by: Sequence[str] | None = None) -> DataFrame:
    """Shuffled join (``left`` or ``inner``) of a large table to a lookup on equally named keys.

    ``hot`` passes on :func:`heavy_hitters` already measured. ``salt_by`` names columns whose values spread the rows of a
    hot key (default: all); the salt is a hash, so a recomputed task gives the same one.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    keys = list(keys)
    # The table is read to be measured and to be joined; what is more than a scan is written once for that.
    facts = stage(facts, "facts") if _costly(facts) else facts
    hot = heavy_hitters(facts, keys) if hot is None else hot
    (salt,) = free([*facts.columns, *lookup.columns], "salt_")
    with_key, without = facts.filter(~any_null(keys)), facts.filter(any_null(keys))
    other = lookup.filter(~any_null(keys))
    if hot:
        salts = F.create_map(*[x for k, n in hot.items() for x in (F.lit(k), F.lit(n))])
        many = F.coalesce(F.try_element_at(salts, _encoded(keys)), F.lit(1))
        row_hash = F.xxhash64(*(salt_by or facts.columns))
        left = with_key.withColumn(salt, F.pmod(row_hash, many).cast("int"))
        right = other.withColumn(salt, F.explode(F.sequence(F.lit(0), many - 1)))
        joined = left.join(right, [*keys, salt], how).drop(salt)
    else:
        joined = with_key.join(other, keys, how)
    if how == "inner":
        return joined
    # Rows without a key are not shuffled: they only get the lookup's columns as nulls.
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name not in keys]
    rest = [F.col(k) for k in keys] + [F.col(c) for c in facts.columns if c not in keys]
    return joined.unionByName(without.select(*rest, *added))
