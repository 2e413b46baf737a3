"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class.

Patterns find assignments, access keys and long hexadecimal strings. The entropy scan takes runs of a
class's characters of at least one window, slides the window over them and keeps the entropy by counts: one
character leaves, one enters, and only their two terms ``c * log2(c)`` change (in millionths, so sums are
exact). Windows above the class's threshold, joined where they touch, are added spans, unless the run
matches the allow-list.

Everything happens inside the row, with built-in expressions: no shuffle, and no row depends on another.
Defined results: null text is empty; positions are code points, ends exclusive; repeated rows are scanned
each; a run found by a pattern and by entropy is listed under both kinds; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.llm.common import free

QUOTE = "[\"']?"
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = f"(?i:({KEYWORDS})){QUOTE}\\x20*[:=]\\x20*{QUOTE}([A-Za-z0-9+/_.=-]+)"
#: Kinds in their order: pattern, group that must be long enough, its least length.
PATTERNS = {"assign": (ASSIGN, 2, 8), "access": ("AKIA[A-Z0-9]{12,}", 0, 16), "hex": ("[0-9a-f]{32,}", 0, 32)}
WINDOW = 20
#: Class of characters and least entropy in bits of a window: random strings have about 3.4 and 4.1.
CLASSES = {"entropy_hex": ("0-9a-fA-F", 3.0), "entropy_base64": ("A-Za-z0-9+/_-", 3.9)}
#: Runs that are no secrets however they spread: identifiers in UUID form, alphabets, placeholders, words, counted digits.
ALLOWED = ("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|abcdefghij|ABCDEFGHIJ|0123456789|EXAMPLE|[Ee]xample"
           "|^[A-Z]?[a-z]+([-_/][A-Z]?[a-z]+)*$|^[A-Z_-]+$")
TERMS = tuple(round(c * math.log2(c) * 1e6) if c else 0 for c in range(WINDOW + 2))
SPANS = "array<struct<first:int,stop:int>>"


def limit(bits: float) -> int:
    """Largest sum of terms at which a window has at least that entropy."""
    return math.floor(WINDOW * 1e6 * (math.log2(WINDOW) - bits))


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(text: str, pattern: str, group: int, least: int) -> str:
    """SQL: spans (``first``, ``stop``, ``run``) of all matches whose group is long enough."""
    p = quoted(pattern)
    step = ("aggregate(sequence(0, size(ms) - 1), struct(0 as at, cast(array() as array<struct<first:int,stop:int,run:string>>) as spans),"
            " (a, i) -> struct(a.at + length(gaps[i]) + length(ms[i]) as at, if(length(gs[i]) < {least}, a.spans,"
            " array_append(a.spans, struct(a.at + length(gaps[i]) as first, a.at + length(gaps[i]) + length(ms[i]) as stop, ms[i] as run))) as spans),"
            " a -> a.spans)").format(least=least)
    parts = f"transform(array(struct(split({text}, {p}, -1) as gaps, regexp_extract_all({text}, {p}, 0) as ms, regexp_extract_all({text}, {p}, {group}) as gs))"
    for name in ("gaps", "ms", "gs"):
        step = step.replace(f"{name}[", f"x.{name}[").replace(f"size({name})", f"size(x.{name})")
    return f"if({text} rlike {p}, element_at({parts}, x -> {step}), 1), cast(array() as array<struct<first:int,stop:int,run:string>>))"


def _windows(run: str, base: str, most: int) -> str:
    """SQL: joined windows of one run whose sum of terms is at most ``most``; positions start at ``base``."""
    terms = f"array({', '.join(f'{t}L' for t in TERMS)})"
    start = f"aggregate(array_distinct(slice(chars, 1, {WINDOW})), 0L, (s, c) -> s + {terms}[{WINDOW} - size(array_remove(slice(chars, 1, {WINDOW}), c))])"
    # i is the new first character; the window before it starts at i - 1.
    before = f"slice(chars, i, {WINDOW})"
    new, old = f"({WINDOW} - size(array_remove({before}, chars[i + {WINDOW - 1}])))", f"({WINDOW} - size(array_remove({before}, chars[i - 1])))"
    change = (f"if(i = 0 or chars[i - 1] = chars[i + {WINDOW - 1}], 0L,"
              f" {terms}[{new} + 1] - {terms}[{new}] + {terms}[{old} - 1] - {terms}[{old}])")
    place = f"struct({base} + i as first, {base} + i + {WINDOW} as stop)"
    merged = (f"if(s > {most}L, a.spans, if(size(a.spans) > 0 and element_at(a.spans, -1).stop >= {base} + i,"
              f" array_append(slice(a.spans, 1, size(a.spans) - 1), struct(element_at(a.spans, -1).first as first, {base} + i + {WINDOW} as stop)),"
              f" array_append(a.spans, {place})))")
    step = f"element_at(transform(array(a.sum + {change}), s -> struct(s as sum, {merged} as spans)), 1)"
    scan = (f"aggregate(sequence(0, size(chars) - {WINDOW}), struct({start} as sum, cast(array() as {SPANS}) as spans), (a, i) -> {step}, a -> a.spans)")
    return f"element_at(transform(array(slice(split({run}, ''), 1, length({run}))), chars -> {scan}), 1)"


def spans_of(text: Column | str) -> dict[str, Column]:
    """Spans per kind, as arrays of (``first``, ``stop``), of a text column that is never null."""
    out = {kind: F.expr(f"transform({_found(text, *rule)}, f -> struct(f.first, f.stop))") for kind, rule in PATTERNS.items()}
    for kind, (letters, bits) in CLASSES.items():
        runs = f"filter({_found(text, f'[{letters}]{{{WINDOW},}}', 0, WINDOW)}, f -> not f.run rlike {quoted(ALLOWED)})"
        out[kind] = F.expr(f"flatten(transform({runs}, f -> {_windows('f.run', 'f.first', limit(bits))}))")
    return out


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``secrets``, a map-like array of (``first``, ``kind_no``, ``kind``, ``stop``), sorted, to every row."""
    text, *kinds = free(docs, "t_", *(f"{k}_" for k in (*PATTERNS, *CLASSES)))
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumns(dict(zip(kinds, spans_of(text).values())))
    listed = [
        f"transform({col}, s -> struct(s.first as first, {no} as kind_no, '{kind}' as kind, s.stop as stop))"
        for no, (col, kind) in enumerate(zip(kinds, (*PATTERNS, *CLASSES)))]
    return df.withColumn("secrets", F.expr(f"sort_array(concat({', '.join(listed)}))")).drop(text, *kinds)
