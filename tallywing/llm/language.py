"""Language identification by rank-order profiles of character n-grams.

A language's profile lists the ``PROFILE`` most frequent n-grams of all its training texts, a document's those
of its own text. The out-of-place distance adds up by how many ranks each n-gram of the document is off in the
language's profile, with ``PROFILE`` for one that is missing; the least distance wins, ties the least name.
N-grams have one to ``LONGEST`` characters of a word in lower case, with one blank on either side.

Each task adds up the n-grams of a language before they are shuffled, so a language with most of the rows
reaches its reducer as distinct n-grams. The profiles are broadcast; their size is the number of labels times
``PROFILE``, and more than ``MAX_LABELS`` labels are an error, since such a column holds no languages.

Defined results: null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing
was learned; a null label or id: the row is not learned from (a null id is not held out, yet has no fold);
repeated rows are learned as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallywing.llm.common import small

FOLDS, HELD = 4, 2
PROFILE, LONGEST, MAX_LABELS = 400, 3, 5000
_LETTERS = re.compile(r"[^\W\d_]+")
_BLANK = 32


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as numbers, with their counts."""
    words = _LETTERS.findall((text or "").lower())
    if not words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    parts, value, inside = [codes[codes != _BLANK]], codes, codes != _BLANK
    for n in range(2, LONGEST + 1):
        value = (value[:-1] << 21) | codes[n - 1 :]
        # A blank may stand first or last, never between.
        between = np.ones(len(value), dtype=bool)
        for k in range(1, n - 1):
            between &= inside[k : k + len(value)]
        parts.append(value[between])
    return np.unique(np.concatenate(parts), return_counts=True)


def profile(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams in order, ties by their number."""
    return names[np.lexsort((names, -counts))[:PROFILE]]


class Profiles:
    """Out-of-place distances to all languages at once."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.labels = sorted(ranked)
        self.known = np.unique(np.array([g for gs in ranked.values() for g in gs], dtype=np.int64))
        self.ranks = np.full((len(self.labels), len(self.known) + 1), -1, dtype=np.int64)
        for row, label in enumerate(self.labels):
            self.ranks[row, np.searchsorted(self.known, np.array(ranked[label], dtype=np.int64))] = np.arange(len(ranked[label]))

    def best(self, text: str | None) -> tuple[str, float]:
        own = profile(*grams(text))
        if not len(own) or not self.labels:
            return "und", 0.0
        at = np.searchsorted(self.known, own)
        at = np.where(self.known[np.minimum(at, len(self.known) - 1)] == own, at, len(self.known))
        ranks = self.ranks[:, at]
        off = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(off.argmin())
        return self.labels[best], float(1 - off[best] / (PROFILE * len(own)))


def learn(rows: DataFrame) -> Profiles:
    """Profiles from rows (``lang``, ``text``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = [grams(t) for t in texts]
                names, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([f[1] for f in found]), minlength=len(names))
                yield pd.DataFrame({"lang": lang, "gram": names, "n": counts.astype(np.int64)})

    rows = rows.filter("lang is not null and text is not null")
    counts = rows.mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = small(counts.withColumn("rank", F.row_number().over(best)).filter(f"rank <= {PROFILE}"), "profiles")
    labels = top.select("lang").distinct().count()
    if labels > MAX_LABELS:
        raise ValueError(f"{labels} different labels; a column of languages has at most {MAX_LABELS}")
    ranked: dict[str, list[int]] = {}
    for r in top.sort("lang", "rank").collect():  # labels times PROFILE rows
        ranked.setdefault(r.lang, []).append(r.gram)
    return Profiles(ranked)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``; learned from labelled rows that are not held out."""
    kind = docs.schema[id_col].dataType.simpleString()
    fold = F.crc32(F.col(id_col).cast("string")) % FOLDS
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(fold == HELD, F.lit(False)).alias("held_out"),
                       fold.alias("fold"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    profiles = learn(rows.filter(f"fold != {HELD}").select("lang", "text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [profiles.best(t if isinstance(t, str) else None) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "held_out": batch["held_out"],
                                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    out = rows.select("id", "held_out", "text").mapInPandas(run, f"id {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
