"""Removal of repeated multi-line chunks with content-defined boundaries.

A rolling hash over the hashes of two neighbouring lines with words (blank lines between them belong to the window)
moves line by line through every text. Where it takes a value that stands anywhere else, too, a chunk goes on; where
it does not, the chunk ends. Boundaries thus depend on the lines next to them alone: inserted or deleted lines move none
elsewhere, and a repeated passage is one chunk from its first line to its last, however short.

Windows that were met more than once are compared byte by byte. Of equal windows the first (least id, then least hash of
the text, then least line) stays; the others are removed, but for lines that a first one holds. So every repeated
line pair stands once in what is left: a first occurrence is never cut by a window that overlaps it.

Counting reads hashes only. Texts are not shuffled: the rows are written once, bucketed by the task that writes them, and
candidate windows and removals come to them by task and row number. A window that stands in a third of all rows is counted
on the map side, and its rows meet one row of the other side in joins that Spark can split.

Defined results: null text has one empty line and stays null; single lines are never removed; of rows that repeat id and
text (also with null ids) one is treated as above and the others lose everything from their first line with words to
their last, if there are two; a null id sorts first; a window that overlaps its own first occurrence (one line many
times in a row) is not counted as another; an empty table gives no rows; columns of the input keep their values,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallywing.llm.common import release, row_key, small
from tallywing.session import spread, stage_by_task

WORD = r"'[^ \\t-\\r]'"
PLACES = "array<struct<first:int,n:int>>"
#: Where a row stands in the staged table.
PLACE = ["task_", "at_"]


def _with_windows(df: DataFrame) -> DataFrame:
    """Add ``lines_`` and ``windows_`` (first line, lines, rolling hash) to rows with ``text_``."""
    df = df.withColumn("lines_", F.expr("split(coalesce(text_, ''), '\\n', -1)"))
    df = df.withColumn("worded_", F.expr(f"filter(sequence(0, size(lines_) - 1), i -> lines_[i] rlike {WORD})"))
    df = df.withColumn("hashes_", F.expr("transform(worded_, i -> xxhash64(lines_[i]))"))
    # Two lines of one hash each; the blank lines between them are compared with the bytes.
    rolled = f"xxhash64(hashes_[k], hashes_[k + 1], worded_[k + 1] - w)"
    return df.withColumn("windows_", F.expr(
        f"transform(slice(worded_, 1, greatest(size(worded_) - 1, 0)), (w, k) -> struct(w as first, worded_[k + 1] - w + 1 as n, {rolled} as hash))"
    )).drop("worded_", "hashes_")


def removals(rows: DataFrame) -> DataFrame:
    """Per row (``task_``, ``at_``) the windows to remove and those to leave: ``gone_``, ``stay_``.

    ``rows`` are those of a staged table, with ``key_``, ``id_`` and ``text_``. Rows of one key count as one document.
    """
    # The plain ``explode`` would add a filter that works out all windows inside itself, once more for every line.
    hashed = _with_windows(rows).select(*PLACE, F.explode_outer("windows_").alias("w_")).filter("w_ is not null").select(*PLACE, "w_.*")
    often = hashed.groupBy("hash").agg(F.count("*").alias("times_")).filter("times_ > 1")
    wanted = hashed.join(often, "hash").groupBy(*PLACE).agg(F.collect_set(F.struct("first", "n")).alias("places_"))
    # The bytes: cut the candidates out of their texts once and write them.
    # The outer array has one element, so a text is split once and not again for every window.
    chunk = F.expr(
        "transform(array(split(coalesce(text_, ''), '\\n', -1)), ls -> transform(places_, p ->"
        " struct(p.first as first, p.n as n, array_join(slice(ls, p.first + 1, p.n), '\\n') as chunk_)))[0]")
    cut = rows.join(wanted.hint("shuffle_hash"), PLACE).select(*PLACE, "key_", "id_", F.explode_outer(chunk).alias("c_"))
    cut = small(cut.select(*PLACE, "key_", "id_", "c_.*"), "windows")
    first = cut.groupBy("chunk_").agg(F.min(F.struct("id_", "key_", "first")).alias("kept_"), F.count("*").alias("times_")).filter("times_ > 1")
    met = cut.join(first, "chunk_").select(
        *PLACE, F.struct("first", "n").alias("place_"), F.expr("key_ = kept_.key_ and first = kept_.first").alias("is_first_"),
        # Only windows with a line in common with their first occurrence stay besides it.
        F.expr("key_ != kept_.key_ or first >= kept_.first + n").alias("is_gone_"))
    found = small(met.filter("is_first_ or is_gone_").groupBy(*PLACE).agg(
        F.collect_set(F.when(F.col("is_gone_"), F.col("place_"))).alias("gone_"), F.collect_set(F.when(F.col("is_first_"), F.col("place_"))).alias("stay_")), "removals")
    release(cut)
    return found


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report_col: str | None = None) -> DataFrame:
    """Every row of ``docs`` with all repeated runs of two or more lines with words cut out of its text.

    ``report_col`` adds a struct of ``n_lines``, ``n_removed_lines`` and ``n_removed_runs``. The rows are written to the
    shared folder once and read from there: ``release`` of the result deletes them when it is written itself.
    """
    names = docs.columns
    spread_docs = spread(docs, row_key(id_col, text_col))
    staged = stage_by_task(spread_docs.select(F.struct(*(F.col(c) for c in names)).alias("row_")), "line_texts", *PLACE)
    id_, text_ = f"row_.`{id_col}`", f"row_.`{text_col}`"
    rows = staged.select(*PLACE, row_key(id_, text_).alias("key_"), F.col(id_).alias("id_"), F.col(text_).alias("text_"))
    gone = removals(rows)
    # A bucket's removals are as few as its rows; looked up by hash, they spare sorting the texts.
    df = staged.select("row_", *PLACE, F.col(text_).alias("text_")).join(gone.hint("shuffle_hash"), PLACE, "left")
    df = _numbered(df, rows.select(*PLACE, "key_")).withColumn("lines_", F.expr("split(coalesce(text_, ''), '\\n', -1)"))

    def covered(places: str) -> str:
        return f"flatten(transform(coalesce({places}, cast(array() as {PLACES})), g -> sequence(g.first, g.first + g.n - 1)))"

    # Of a row that is there again all that a window covers goes.
    worded = f"filter(sequence(0, size(lines_) - 1), i -> lines_[i] rlike {WORD})"
    df = df.withColumn("removed_", F.expr(
        f"case when copy_ > 1 then aggregate(array({worded}), cast(array() as array<int>), (a, w) -> if(size(w) < 2, a, sequence(w[0], element_at(w, -1))))"
        f" when gone_ is null then cast(array() as array<int>) else array_sort(array_except({covered('gone_')}, {covered('stay_')})) end"))
    left = "array_except(sequence(0, size(lines_) - 1), removed_)"
    kept = F.expr(f"if(text_ is null or size(removed_) = 0, text_, array_join(transform({left}, i -> lines_[i]), '\\n'))")
    runs = "size(array_distinct(transform(removed_, (x, k) -> x - k)))"
    report = F.expr(f"struct(cast(size(lines_) as bigint) as n_lines, cast(size(removed_) as bigint) as n_removed_lines, cast({runs} as bigint) as n_removed_runs)")
    df = df.select("row_", kept.alias("kept_text_"), report.alias("report_"))
    columns = [F.col("kept_text_").alias(c) if c == text_col else F.col(f"row_.`{c}`").alias(c) for c in names if c != report_col]
    df = df.select(*columns, *([F.col("report_").alias(report_col)] if report_col else []))
    df.staged_path = staged.staged_path
    return df


def _numbered(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``df`` with ``copy_``: 1, 2, ... among rows of one key. Only ``keys`` (``task_``, ``at_``, ``key_``) are shuffled, without texts."""
    twice = small(keys.groupBy("key_").agg(F.count("*").alias("times_")).filter("times_ > 1").select("key_"), "twice")
    if twice.isEmpty():
        return df.withColumn("copy_", F.lit(1))
    copy = F.row_number().over(Window.partitionBy("key_").orderBy(*PLACE))
    copies = small(keys.join(twice, "key_").select(*PLACE, copy.alias("copy_")).filter("copy_ > 1"), "copies")
    return df.join(copies.hint("shuffle_hash"), PLACE, "left").withColumn("copy_", F.coalesce("copy_", F.lit(1)))
