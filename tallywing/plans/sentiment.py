"""Six sentiment classifiers over the cleaned table, and how well each agrees with gold labels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywing.constants import SENTIMENT_DROP
from tallywing.operators.sentiment import accuracy, add_labels, match_flags
from tallywing.plans.clean import clean_feedback


def classify_feedback(
    raw: DataFrame, vocab: DataFrame, gold: str = "airline_sentiment_gold", line_break: str = " "
) -> DataFrame:
    """All cleaned rows, with six labels and six match flags; a filler in ``gold`` matches nothing.

    Line breaks and tabs become ``line_break``, a blank, so that words on either side stay apart.
    """
    rows = clean_feedback(raw, drop=SENTIMENT_DROP, line_break=line_break)
    return match_flags(add_labels(rows, "text", vocab), gold)


def classifier_accuracy(classified: DataFrame, gold: str = "airline_sentiment_gold") -> DataFrame:
    return accuracy(classified, gold)
