"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned for in every token window.

Words are runs of digits, lower-cased Latin letters and all characters beyond ASCII. A window is ten
consecutive words of an item, or a whole item of fewer words. Every window of a text of such a length is
hashed and looked up; a hit counts after its words were compared. The set of test windows is broadcast
only when it was measured to stay below ``MAX_WINDOWS`` rows and ``MAX_BYTES``; beyond that the same join
is shuffled.

Defined results: null text or item has no words; windows that several items share count for each of
them; items that repeat under one id count once; rows with the same id and text get the same answer; an
empty benchmark leaves every text clean; an item with a null id still hits words but is in no list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import bounded, row_key, small

#: Words of a window.
WINDOW = 10
#: Bound of the broadcast.
MAX_WINDOWS, MAX_BYTES = 1_000_000, 64 << 20
NOT_WORD = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str) -> str:
    """SQL: A to Z in lower case and nothing else changed; plain ASCII texts take the quick way."""
    return f"if(octet_length({text}) = length({text}), lower({text}), translate({text}, '{_UPPER}', '{_LOWER}'))"


def _words(df: DataFrame) -> DataFrame:
    df = df.withColumn("text_", F.coalesce("text_", F.lit("")))
    df = df.withColumn("low_", F.expr(ascii_lower("text_")))
    return df.withColumn("words_", F.expr(f"filter(split(low_, '{NOT_WORD}'), w -> w != '')")).drop("low_")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (``item_``, ``size_``, ``window_``, ``hash_``) of the benchmark, written once."""
    df = _words(benchmark.select(F.col(id_col).alias("item_"), F.col(text_col).alias("text_")))
    df = df.filter("size(words_) > 0").withColumn("size_", F.expr(f"least(size(words_), {WINDOW})"))
    df = df.select("item_", "words_", "size_", F.explode(F.expr("sequence(0, size(words_) - size_)")).alias("i_"))
    df = df.withColumn("part_", F.expr("slice(words_, i_ + 1, size_)"))
    windows = df.select("item_", "size_", F.array_join("part_", " ").alias("window_"),
                        F.expr("aggregate(transform(part_, w -> xxhash64(w)), 42L, (a, h) -> xxhash64(a, h))").alias("hash_"))
    return small(windows.distinct(), "windows")


def hits(docs: DataFrame, windows: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document with a hit: ``key_``, ``spans_`` (first word, words), ``windows_``."""
    sizes = [r[0] for r in windows.select("size_").distinct().sort("size_").collect()]  # at most WINDOW numbers
    table = windows.select("hash_", "window_").distinct()
    count, size = table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window_") + 16), F.lit(0))).first()
    if count <= MAX_WINDOWS and size <= MAX_BYTES:
        table = F.broadcast(table)
    df = _words(docs.select(row_key(id_col, text_col).alias("key_"), F.col(text_col).alias("text_"))).select("key_", "words_")
    df = df.withColumn("h_", F.expr("transform(words_, w -> xxhash64(w))"))

    def hashed(n: int) -> str:
        value = "42L"
        for k in range(n):
            value = f"xxhash64({value}, h_[i + {k}])"
        return f"if(size(h_) < {n}, array(), transform(sequence(0, size(h_) - {n}), i -> {value}))"

    parts = [
        df.select("key_", "words_", F.lit(n).alias("n_"), F.posexplode(F.expr(hashed(n))).alias("i_", "look_")) for n in sizes
    ] or [df.select("key_", "words_", F.lit(0).alias("n_"), F.lit(0).alias("i_"), F.lit(0).cast("bigint").alias("look_")).limit(0)]
    found = []
    for part in parts:
        same = F.expr("look_ = hash_ and array_join(slice(words_, i_ + 1, n_), ' ') = window_")
        found.append(part.join(table, same).select("key_", "i_", "n_", "window_"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    return rows.groupBy("key_").agg(F.collect_set(F.struct("i_", "n_")).alias("spans_"), F.collect_set("window_").alias("windows_"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside a hit), ``items`` (sorted ids as text)."""
    windows = item_windows(benchmark, item_col, item_text)
    found = small(hits(docs, windows, text_col, id_col), "hits")
    items = found.select("key_", F.explode("windows_").alias("window_")).join(windows.select("window_", "item_"), "window_")
    items = items.groupBy("key_").agg(F.sort_array(F.collect_set(F.col("item_").cast("string"))).alias("items"))
    covered = F.expr("aggregate(sort_array(spans_), struct(0L as n, 0 as stop), (a, s) -> struct("
                     "a.n + greatest(0, s.i_ + s.n_ - greatest(s.i_, a.stop)) as n, greatest(a.stop, s.i_ + s.n_) as stop), a -> a.n)")
    found = found.select("key_", covered.alias("n_hit")).join(items, "key_", "left")
    counted = _words(docs.select(F.col(id_col), row_key(id_col, text_col).alias("key_"), F.col(text_col).alias("text_")))
    counted = counted.select(id_col, "key_", F.expr("cast(size(words_) as bigint)").alias("n_words"))
    return counted.join(found, "key_", "left").select(
        id_col, "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without contaminated rows (``remove="documents"``) or without the hit words (``"spans"``).

    With spans, hit words and what separates them from each other go; all other characters stay.
    """
    names = docs.columns
    found = small(hits(docs, item_windows(benchmark, item_col, item_text), text_col, id_col), "hits")
    rows = docs.select(F.struct(*(F.col(c) for c in names)).alias("row_"), row_key(id_col, text_col).alias("key_"), F.col(text_col).alias("text_"))
    if remove == "documents":
        # Keys counted to be few go to the texts, which are shuffled only beyond that.
        return rows.join(bounded(found.select("key_"), MAX_WINDOWS), "key_", "left_anti").select("row_.*")
    if remove != "spans":
        raise ValueError(f"remove {remove!r}: documents or spans")
    df = rows.join(found.select("key_", "spans_"), "key_", "left")
    word = r"[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"
    df = df.withColumns({"words_": F.expr(f"regexp_extract_all(text_, '{word}', 0)"), "gaps_": F.expr(f"split(text_, '{word}', -1)")})
    df = df.withColumn("hit_", F.expr("array_distinct(flatten(transform(spans_, s -> sequence(s.i_, s.i_ + s.n_ - 1))))"))
    # Hit words in order, then runs of the others: no search per word.
    df = df.withColumn("hit_", F.expr("array_union(array(-1), array_append(sort_array(hit_), size(words_)))"))
    runs = ("transform(slice(hit_, 2, size(hit_) - 1), (stop, k) -> if(stop - hit_[k] = 1 and stop < size(words_) and hit_[k] >= 0, '',"
            " concat(array_join(transform(sequence(0, stop - hit_[k] - 1), j -> concat("
            "if(j = 0, '', words_[hit_[k] + j]), gaps_[hit_[k] + j + 1])), ''))))")
    df = df.withColumn("clean_", F.expr(f"if(spans_ is null, text_, array_join({runs}, ''))"))
    return df.select(*(F.col("clean_").alias(c) if c == text_col else F.col(f"row_.`{c}`").alias(c) for c in names))
