"""Language-model scores of texts: a word unigram base and a subword lattice likelihood.

The vocabulary of pieces exists already (a public tokenizer file). Its pieces weigh by how often the
tokenizer uses them in the training words, smoothed. A word's probability is the sum over all its
segmentations into pieces, by a forward recursion in log space; pieces never cross words, so a text's is
the product over its words and the end. A character that is no piece is spelled by its byte pieces.

Word counts are merged per task before they are shuffled. Texts are dealt to blocks of about
``BLOCK_BYTES``; each block asks once for each of its words, so the commonest word meets as many rows
as there are blocks, and gets back the word's count and log probability. Only the pieces' weights pass
through the driver, and the vocabulary's size bounds them.

Defined results: null text is empty and has the end token alone; a row with a null id trains; repeated
rows train as often as they occur; with no training rows every token is unknown and pieces weigh the same;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import row_key, small

FOLDS, ADDED = 10, 0.1
BLOCK_BYTES = 32 << 20
#: Distinct words a task holds before it hands on their counts.
HELD_WORDS = 400_000
SPACE = "▁"


def tokens(text: str | None) -> list[bytes]:
    """Words in ASCII lower case, split at ASCII white space; the end token is not listed."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``n`` (times in rows that are not ``held``) of all words in rows (``held``, ``text``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def taken() -> pd.DataFrame:
            return pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())})

        for batch in batches:
            for is_held, text in zip(batch["held"], batch["text"]):
                words = tokens(text if isinstance(text, str) else None)
                seen.update(dict.fromkeys(words, 0) if is_held else words)
                if len(seen) > HELD_WORDS:
                    yield taken()
                    seen.clear()
        if seen:
            yield taken()

    return rows.select("held", "text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece_weights(counts: DataFrame, vocabulary: str, ends: int) -> tuple[dict[str, float], float]:
    """Natural logarithms of the pieces' probabilities, and that of the end."""
    from sentencepiece import SentencePieceProcessor

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = SentencePieceProcessor(model_file=vocabulary)
        total = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            for ids, n in zip(model.encode(list(batch["word"]), num_threads=1), batch["n"]):
                for i in ids:
                    total[i] += n
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used.astype(np.int64), "n": total[used]})

    rows = counts.mapInPandas(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    used = {r.piece: r.n for r in rows.collect()}  # at most the size of the vocabulary
    model = SentencePieceProcessor(model_file=vocabulary)
    names = {i: model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    # Pieces with a blank inside cannot occur in a word.
    names = {i: p for i, p in names.items() if SPACE not in p[1:]}
    total = sum(used.get(i, 0) for i in names) + ends + ADDED * (len(names) + 1)
    weights = {p: math.log((used.get(i, 0) + ADDED) / total) for i, p in names.items()}
    return weights, math.log((ends + ADDED) / total)


class Lattice:
    """Log probability of a word, summed over all its segmentations."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.longest = max(map(len, weights), default=1)

    def _spelled(self, char: str) -> float:
        return sum(self.weights[f"<0x{b:02X}>"] for b in char.encode())

    def score(self, word: str) -> float:
        w, get, longest, exp, log = SPACE + word, self.weights.get, self.longest, math.exp, math.log
        forward = [0.0]
        for j in range(1, len(w) + 1):
            terms = []
            for i in range(max(0, j - longest), j):
                p = get(w[i:j])
                if p is not None:
                    terms.append(forward[i] + p)
            if get(w[j - 1]) is None:
                terms.append(forward[j - 1] + self._spelled(w[j - 1]))
            top = max(terms)
            forward.append(top if len(terms) == 1 else top + log(sum([exp(t - top) for t in terms])))
        return forward[-1]


def score_texts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (both log10)."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    counts = small(word_counts(rows), "counts")
    ends, size = rows.agg(F.coalesce(F.sum((~F.col("held")).cast("long")), F.lit(0)),
                          F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    total, distinct = n + ends, v + (ends > 0)
    weights, end = piece_weights(counts.filter("n > 0"), vocabulary, ends)

    def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(weights)
        for batch in batches:
            yield batch.assign(p=[lattice.score(w) for w in batch["word"]])

    known = small(counts.mapInPandas(weighed, "word string, n long, p double"), "words")
    blocks = max(1, -(-size // BLOCK_BYTES))
    dealt = rows.select("id", "held", "text", F.pmod("key", F.lit(blocks)).alias("block"))

    def asked(frame: pd.DataFrame) -> pd.DataFrame:
        words = set()
        for text in frame["text"]:
            words.update(tokens(text if isinstance(text, str) else None))
        return pd.DataFrame({"word": [w.decode() for w in sorted(words)], "block": frame["block"].iloc[0]})

    asking = dealt.groupBy("block").applyInPandas(asked, "word string, block long")
    answers = asking.join(known, "word").select("block", "word", F.col("n").alias("c"), "p")

    floor = math.log10(ADDED)
    down = math.log10(total + ADDED * (distinct + 1))

    def scored(texts: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        at = {w.encode(): i for i, w in enumerate(known["word"])}
        c = known["c"].to_numpy()
        base = np.where(c > 0, np.log10(c + ADDED), floor) - down
        p = known["p"].to_numpy()
        out = []
        for doc, is_held, text in zip(texts["id"].astype(object), texts["held"], texts["text"]):
            ids = np.array([at[w] for w in tokens(text if isinstance(text, str) else None)], dtype=np.int64)
            out.append((
                None if pd.isna(doc) else doc, is_held, len(ids) + 1, int((c[ids] > 0).sum()) + (ends > 0), total,
                float(base[ids].sum()) + math.log10(ends + ADDED) - down, (float(p[ids].sum()) + end) / math.log(10)))
        return pd.DataFrame(out, columns=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema).withColumnRenamed("id", id_col)
