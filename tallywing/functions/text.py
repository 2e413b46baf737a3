"""String and array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: A word's characters: letters and marks of any script, and the apostrophe.
WORD_CHARACTERS = "[\\p{L}\\p{M}']"


def replace_control(text: Column, replacement: str = "") -> Column:
    """Replace each newline, carriage return and tab."""
    return F.regexp_replace(text, "[\\n\\r\\t]", replacement)


def single_quotes(text: Column) -> Column:
    """Double quotes become single quotes."""
    return F.translate(text, '"', "'")


def fold(text: Column) -> Column:
    """Trimmed and upper-cased, for comparisons that ignore case and padding."""
    return F.upper(F.trim(text))


def composite_key(*parts: Column) -> Column:
    """Render parts joined by ``_`` (for output; group on the real columns)."""
    return F.concat_ws("_", *parts)


def split_composite_key(key: Column) -> tuple[Column, Column]:
    """Undo :func:`composite_key` at the first ``_`` only."""
    parts = F.split(key, "_", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def split_items(text: Column, count: int = 2) -> list[Column]:
    """Items of a field holding several values separated by a line break or ``&``.

    Missing items are null; an item's own padding is removed.
    """
    items = F.split(text, "\\r?\\n|&")
    return [F.trim(F.get(items, F.lit(i))) for i in range(count)]


def before_comma(text: Column) -> Column:
    """The text up to the first comma, e.g. the city of ``City, Region``."""
    return F.substring_index(text, ",", 1)


def words(text: Column, fold: bool = True) -> Column:
    """Lower-case words (letters of any script) in order; ``fold=False`` for a text already in lower case."""
    return F.regexp_extract_all(F.lower(text) if fold else text, F.lit(f"({WORD_CHARACTERS}+)"), F.lit(1))


def top_of_lists(values: Column, counts: Column, n: int) -> Column:
    """The ``n`` values with the largest counts, from two parallel arrays; ties by value."""
    pairs = F.arrays_zip(values.alias("v"), counts.alias("n"))
    ranked = F.array_sort(
        pairs,
        lambda a, b: F.when(a["n"] > b["n"], -1)
        .when(a["n"] < b["n"], 1)
        .when(a["v"] < b["v"], -1)
        .when(a["v"] > b["v"], 1)
        .otherwise(0),
    )
    return F.transform(F.slice(ranked, 1, n), lambda p: p["v"])
