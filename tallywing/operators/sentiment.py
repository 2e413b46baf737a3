"""Lexicon sentiment as table operators: tokens, a scored vocabulary, grouped sums, thresholds."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywing.constants import (
    COMPOUND_ALPHA,
    COMPOUND_THRESHOLD,
    HIGHER_THRESHOLD,
    LABEL_COLUMNS,
    LOWER_THRESHOLD,
    NEGATIONS,
    SCORED_POS,
    THRESHOLD,
    TREEBANK_POS,
    UNKNOWN,
)
from tallywing.functions.text import WORD_CHARACTERS, words
from tallywing.functions.values import label_by_threshold, same_value
from tallywing.operators.joins import join_by_frequency, join_lookup
from tallywing.operators.naming import free
from tallywing.session import settle, stage_by_task


def lexicon_pos(treebank_tag: Column) -> Column:
    """Part of speech of a treebank tag, as lexicons spell it; null when it has none."""
    pairs = [F.lit(part) for pair in TREEBANK_POS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.substring(treebank_tag, 1, 1))


def tokenize(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, word), one row per word."""
    return docs.select(key, F.posexplode(words(F.col(text))).alias("pos", "word"))


def _first_sense(lexicon: DataFrame) -> list[Column]:
    """Order of the entries that a word has under one part of speech: by ``sense``, where the lexicon numbers them.

    Of entries with one number, or without numbers, the greatest positive score counts, then the least negative one.
    """
    number = [F.col("sense")] if "sense" in lexicon.columns else []
    return [*number, -F.col("pos_score"), F.col("neg_score")]


def vocabulary(
    lexicon: DataFrame, stop_words: DataFrame | None = None, valences: DataFrame | None = None
) -> DataFrame:
    """One row per scored word: ``delta`` (positive minus negative score), ``is_stop``, ``valence``.

    ``lexicon`` is (word, pos, pos_score, neg_score) and may number a word's senses (``sense``, the first one counts).
    Only nouns, adjectives and adverbs score; a word listed under several of them takes the first in that order.
    ``stop_words`` is (word) and ``valences`` is (word, valence). Stop words are marked here once rather than looked up
    per token.
    """
    order = F.array_position(F.array(*[F.lit(p) for p in SCORED_POS]), F.col("pos"))
    scored = (
        lexicon.filter(F.col("pos").isin(*SCORED_POS))
        .groupBy(F.lower("word").alias("word"))
        .agg(F.min_by(F.col("pos_score") - F.col("neg_score"), F.struct(order, *_first_sense(lexicon))).alias("delta"))
    )
    if stop_words is None:
        scored = scored.withColumn("is_stop", F.lit(False))
    else:
        stops = stop_words.select(F.lower("word").alias("word")).distinct().withColumn("_stop", F.lit(True))
        scored = scored.join(stops, "word", "left").withColumn("is_stop", F.coalesce("_stop", F.lit(False))).drop("_stop")
    if valences is None:
        return scored.withColumn("valence", F.lit(None).cast("double"))
    valued = valences.groupBy(F.lower("word").alias("word")).agg(F.max(F.col("valence").cast("double")).alias("valence"))
    return scored.join(valued, "word", "full_outer")


def tagged_scores(tokens: DataFrame, key: str, lexicon: DataFrame, stop_words: DataFrame | None = None) -> DataFrame:
    """(key, score, score_no_stop, score_negated) for tokens that a tagger marked: ``tokens`` is (key, pos, word, tag).

    Each word is looked up under the part of speech of its own tag, so one word can score differently in different
    places; of several senses the first counts (see :func:`vocabulary`). ``score_no_stop`` leaves out stop words.
    In ``score_negated`` a negation word scores nothing and flips a flag; a scored word is inverted while the flag is up
    and lowers it. 0 where no word scores. Only scored words and negation words are put in order.
    """
    entries = (
        lexicon.filter(F.col("pos").isin(*SCORED_POS))
        .groupBy(F.lower("word").alias("_word"), F.col("pos").alias("_pos"))
        .agg(F.min_by(F.col("pos_score") - F.col("neg_score"), F.struct(*_first_sense(lexicon))).alias("_delta"))
    )
    entries = settle(entries)
    # Other parts of speech have no entry: without a key these tokens are neither counted nor shuffled to look them up.
    part = lexicon_pos(F.col("tag"))
    part = F.when(part.isin(*SCORED_POS), part).alias("_pos")
    marked = tokens.select(F.col(key).alias("_key"), F.col("pos").alias("_at"), F.lower("word").alias("_word"), part)
    found = join_by_frequency(marked, entries, ["_word", "_pos"])
    if stop_words is None:
        found = found.withColumn("_stop", F.lit(None).cast("boolean"))
    else:
        stops = settle(stop_words.select(F.lower("word").alias("_word")).distinct().withColumn("_stop", F.lit(True)))
        found = join_lookup(found, stops, "_word", "left")
    negation = F.col("_word").isin(*NEGATIONS)
    delta = F.col("_delta")
    # Negation words so far, and how many of them the previous scored word had seen.
    in_order = Window.partitionBy("_key").orderBy("_at")
    plain = F.when(~F.col("_negation"), delta)
    before = F.max(F.when(plain.isNotNull(), F.col("_seen"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = (
        found.withColumn("_negation", negation).filter(delta.isNotNull() | F.col("_negation"))
        .withColumn("_seen", F.sum(F.col("_negation").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_flip", (F.col("_seen") - F.coalesce(before, F.lit(0))) % 2 == 1))

    def mean(value: Column) -> Column:
        return F.when(F.count(value) > 0, F.sum(value) / F.count(value)).otherwise(F.lit(0.0))

    scored = flagged.groupBy("_key").agg(
        mean(delta).alias("score"), mean(F.when(F.col("_stop").isNull(), delta)).alias("score_no_stop"),
        mean(F.when(F.col("_flip"), -plain).otherwise(plain)).alias("score_negated"))
    # Keys without a scored word have zeros; they are known from the tokens alone.
    every = tokens.select(F.col(key).alias("_key")).distinct()
    names = ("score", "score_no_stop", "score_negated")
    return every.join(scored, every["_key"].eqNullSafe(scored["_key"]), "left").select(
        every["_key"].alias(key), *(F.coalesce(n, F.lit(0.0)).alias(n) for n in names))


def _before_negation() -> str:
    """Pattern of the empty string before each negation word that is a whole word.

    The shared first letters are tested first: most positions of a text fail there at once.
    """
    stem = os.path.commonprefix(NEGATIONS)
    endings = "|".join(w[len(stem):] for w in NEGATIONS)
    return f"(?={stem}(?:{endings})(?!{WORD_CHARACTERS}))(?<!{WORD_CHARACTERS})"


def scores(docs: DataFrame, key: str | Sequence[str], text: str, vocab: DataFrame) -> DataFrame:
    """Per document: ``score``, ``score_no_stop``, ``score_negated`` and ``compound``.

    Null for a null or empty text, 0 where no word scores. One pass over the tokens serves all four. ``key`` names the
    column or columns that identify a document; if the table is partitioned by one of them, nothing is shuffled.

    A negation word flips a flag; the next scored word is inverted while the flag is up and lowers
    it. So the text is cut before every negation word, and in each of these runs only the first
    scored word can be inverted: when an odd number of negation words separates it from the previous
    scored word. Runs are summed where the tokens are produced, and only the runs of a document are
    put in order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    body = F.col(text)
    # The leading blank keeps a negation word at the very start from being in run 0.
    tokens = (
        docs.select(*keys, (F.length(body) > 0).alias("_has_text"), F.concat(F.lit(" "), F.lower(body)).alias("_lower"))
        .select(*keys, "_has_text", F.posexplode_outer(F.split("_lower", _before_negation())).alias("run", "_run_text"))
        .select(*keys, "_has_text", "run", F.posexplode_outer(words(F.col("_run_text"), fold=False)).alias("pos", "word"))
    )
    # Cutting a text at negation words leaves its words as they are, so they can be counted without.
    plain_words = docs.select(F.explode(words(body)).alias("word"))
    found = join_by_frequency(tokens, vocab, "word", counted=plain_words)
    delta = F.col("delta")
    kept = F.when(~F.col("is_stop"), delta)
    plain = F.when(~F.col("word").isin(*NEGATIONS), delta)
    plain_at = F.when(plain.isNotNull(), F.col("pos"))
    runs = found.groupBy(*keys, F.coalesce("run", F.lit(0)).alias("run")).agg(
        F.coalesce(F.bool_or("_has_text"), F.lit(False)).alias("_has_text"),
        F.sum(delta).alias("d"), F.count(delta).alias("n"),
        F.sum(kept).alias("d_kept"), F.count(kept).alias("n_kept"),
        F.sum(plain).alias("d_plain"), F.count(plain).alias("n_plain"),
        F.min_by(plain, plain_at).alias("first_plain"),
        F.sum("valence").alias("v"),
    )
    scored_run = F.when(F.col("n_plain") > 0, F.col("run"))
    earlier = Window.partitionBy(*keys).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    since = F.col("run") - F.coalesce(F.max(scored_run).over(earlier), F.lit(0))
    flipped = F.when((F.col("n_plain") > 0) & (since % 2 == 1), F.col("first_plain") * 2).otherwise(F.lit(0.0))
    per_doc = runs.withColumn("_flip", flipped).groupBy(*keys).agg(
        F.bool_or("_has_text").alias("_has_text"),
        F.sum("d").alias("d"), F.sum("n").alias("n"),
        F.sum("d_kept").alias("d_kept"), F.sum("n_kept").alias("n_kept"),
        (F.sum("d_plain") - F.sum("_flip")).alias("d_plain"), F.sum("n_plain").alias("n_plain"),
        F.coalesce(F.sum("v"), F.lit(0.0)).alias("v"),
    )

    def mean(total: str, count: str) -> Column:
        value = F.when(F.col(count) > 0, F.col(total) / F.col(count)).otherwise(F.lit(0.0))
        return F.when(F.col("_has_text"), value)

    v = F.col("v")
    return per_doc.select(
        *keys,
        mean("d", "n").alias("score"),
        mean("d_kept", "n_kept").alias("score_no_stop"),
        mean("d_plain", "n_plain").alias("score_negated"),
        F.when(F.col("_has_text"), v / F.sqrt(v * v + F.lit(COMPOUND_ALPHA))).alias("compound"),
    )


def labels(scored: DataFrame, *keys: str) -> DataFrame:
    """The six label columns of :func:`scores` rows."""
    ways = (
        ("score", THRESHOLD),
        ("score_no_stop", THRESHOLD),
        ("score_negated", THRESHOLD),
        ("score", HIGHER_THRESHOLD),
        ("score", LOWER_THRESHOLD),
        ("compound", COMPOUND_THRESHOLD),
    )
    return scored.select(
        *keys,
        *[label_by_threshold(F.col(c), t).alias(name) for name, (c, t) in zip(LABEL_COLUMNS, ways)],
    )


def add_labels(docs: DataFrame, text: str, vocab: DataFrame) -> DataFrame:
    """``docs`` with the six label columns.

    The table is written once, bucketed by the task that writes it (:func:`tallywing.session.stage_by_task`). Tokens are
    summed and the labels joined back bucket by bucket, so no text is shuffled and no row needs a key of its own.
    """
    task, row = free(docs, "task_", "row_")
    staged = stage_by_task(docs, "texts", task, row)
    found = labels(scores(staged, [task, row], text, vocab), task, row)
    # Labels are looked up by hash, which spares sorting the texts; a bucket's labels are as few as its rows.
    return staged.join(found.hint("shuffle_hash"), [task, row], "left").select(*docs.columns, *LABEL_COLUMNS)


def with_gold(df: DataFrame, gold: str) -> DataFrame:
    """Rows with a real trusted label; a filler is none."""
    return df.filter(F.col(gold) != UNKNOWN)


def match_flags(df: DataFrame, gold: str, classifiers: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Add ``<classifier>_is_matching`` (1 / 0) per classifier."""
    return df.withColumns({f"{c}_is_matching": same_value(F.col(c), F.col(gold)) for c in classifiers})


def accuracy(df: DataFrame, gold: str, classifiers: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """(classifier, matches, total, accuracy in percent) over rows with a trusted label, in one pass."""
    one = with_gold(df, gold).agg(
        F.count("*").alias("total"), *[F.count_if(F.col(c) == F.col(gold)).alias(c) for c in classifiers]
    )
    long = one.unpivot(["total"], list(classifiers), "classifier", "matches")
    share = F.when(F.col("total") > 0, F.col("matches").cast("double") * 100 / F.col("total"))
    return long.select("classifier", "matches", "total", share.alias("accuracy"))


def classify_with(df: DataFrame, text: str, classifier: Callable[[pd.Series], pd.Series], name: str) -> DataFrame:
    """Add the labels of a user's own text classifier, which gets a series of texts and returns their labels.

    Null and empty texts get a null label and are not passed on.
    """

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        labels = pd.Series(None, index=batch.index, dtype=object)
        given = batch[batch.fillna("") != ""]
        if len(given):
            labels[given.index] = classifier(given)
        return labels

    return df.withColumn(name, run(F.col(text)))
