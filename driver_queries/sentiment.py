"""Lexicon sentiment over whole documents; the lexicon is derived from their own words."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.registry import query, r6, table
from tallywing.constants import LABEL_COLUMNS
from tallywing.functions.values import label_by_threshold
from tallywing.operators.sentiment import accuracy, add_labels, labels, match_flags, scores, tagged_scores, tokenize, vocabulary
from tallywing.session import settle, spread

# Scores of a word, from its length and first letter; multiples of 1/8, so sums are exact.
POS = "case length(word) % 5 when 0 then 'n' when 1 then 'a' when 2 then 'r' when 3 then 'v' else 'x' end"
UP = "cast(length(word) * 3 % 8 as double) / 8"
DOWN = "cast(ascii(word) % 8 as double) / 8"
VALENCE = "cast(length(word) % 9 - 4 as double) / 2"


def document_words(spark, sf):
    """Every word of the documents once."""
    return tokenize(documents(spark, sf), "doc_id", "text").select("word").distinct()


def document_lexicon(words):
    first = words.selectExpr("word", f"{POS} as pos", f"{UP} as pos_score", f"{DOWN} as neg_score")
    # Some words are listed under a second part of speech with the scores the other way round.
    second = words.filter("length(word) % 5 = 1").selectExpr(
        "word", "'n' as pos", f"{DOWN} as pos_score", f"{UP} as neg_score"
    )
    return first.unionByName(second)


def document_vocabulary(spark, sf):
    words = settle(document_words(spark, sf))
    stops = words.filter("length(word) <= 2")
    valences = words.filter("length(word) >= 4").selectExpr("word", f"{VALENCE} as valence")
    return settle(vocabulary(document_lexicon(words), stops, valences))


def documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def scored(spark, sf):
    return scores(documents(spark, sf), "doc_id", "text", document_vocabulary(spark, sf))


NEGATION_LIST = "'not', 'never', 'no', 'nobody', 'none', 'nor', 'nothing', 'nowhere'"
# Token-level form: previous scored word by lag, negation words counted by a running sum.
SCORES = f"""
raw as (select doc_id, text, regexp_extract_all(lower(text), '([\\p{{L}}\\p{{M}}'']+)') as ws from documents),
tok as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from raw),
vocab_words as (select distinct word from tok),
lexicon as (select word, {POS} as pos, {UP} as up, {DOWN} as down from vocab_words
            union all select word, 'n', {DOWN}, {UP} from vocab_words where length(word) % 5 = 1),
one as (select word, up, down, row_number() over (partition by word order by case pos when 'n' then 1 when 'a' then 2 else 3 end) k
        from lexicon where pos in ('n', 'a', 'r')),
lex as (select word, up, down from one where k = 1),
val as (select word, {VALENCE} as valence from vocab_words where length(word) >= 4),
t as (select tok.*, up, down, length(tok.word) <= 2 as is_stop, tok.word in ({NEGATION_LIST}) as is_neg, valence
      from tok left join lex using (word) left join val using (word)),
base as (select doc_id, (sum(up) - sum(down)) / count(up) as score,
                (sum(up) filter (where not is_stop) - sum(down) filter (where not is_stop))
                  / nullif(count(up) filter (where not is_stop), 0) as score_no_stop,
                sum(valence) as v from t group by doc_id),
negs as (select *, sum(is_neg::int) over (partition by doc_id order by pos) as c from t),
plain as (select *, coalesce(lag(c) over (partition by doc_id order by pos), 0) as before from negs where up is not null and not is_neg),
flip as (select doc_id, (sum(case when (c - before) % 2 = 1 then down else up end)
                       - sum(case when (c - before) % 2 = 1 then up else down end)) / count(*) as score_negated from plain group by doc_id),
scored as (select doc_id, case when length(text) > 0 then coalesce(score, 0) end as score,
                  case when length(text) > 0 then coalesce(score_no_stop, 0) end as score_no_stop,
                  case when length(text) > 0 then coalesce(score_negated, 0) end as score_negated,
                  case when length(text) > 0 then coalesce(v, 0) / sqrt(coalesce(v, 0) * coalesce(v, 0) + 15) end as compound
           from raw left join base using (doc_id) left join flip using (doc_id))"""


def label_sql(score: str, threshold: float) -> str:
    return (
        f"case when {score} >= {threshold}e0 then 'positive' when {score} <= -{threshold}e0 then 'negative'"
        f" when {score} is not null then 'neutral' end"
    )


def half_up(value):
    """Six digits by arithmetic both engines share: exact ties are frequent among these scores, and
    the engines' ``round`` treats a tie differently."""
    return F.floor(value * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def score_query(name: str, score: str, threshold: float) -> None:
    """Score and label by one classifier."""

    @query(
        f"with {SCORES} select doc_id, floor({score} * 1e6 + 0.5e0) / 1e6 as score, {label_sql(score, threshold)} as label from scored",
        name=name,
    )
    def run(spark, sf):
        return scored(spark, sf).select(
            "doc_id", half_up(F.col(score)).alias("score"), label_by_threshold(F.col(score), threshold).alias("label")
        )


score_query("sentiment_score", "score", 0.1)
score_query("sentiment_high", "score", 0.2)
score_query("sentiment_low", "score", 0.05)
score_query("sentiment_no_stopwords", "score_no_stop", 0.1)
score_query("sentiment_negation", "score_negated", 0.1)
score_query("sentiment_compound", "compound", 0.05)

# Tags that a tagger might give, from the word's place in the text.
TAG = "case pos % 4 when 0 then 'NNS' when 1 then 'JJ' when 2 then 'RBR' else 'VBD' end"


@query(f"""with {SCORES},
e as (select word, pos as p, case when count(*) > 1 then arg_max(up - down, up) else max(up - down) end as delta from lexicon
      where pos in ('n', 'a', 'r') group by word, pos),
g as (select doc_id, word, case pos % 4 when 0 then 'n' when 1 then 'a' when 2 then 'r' else 'v' end as p from tok)
select doc_id, floor(coalesce(sum(delta) / count(delta), 0) * 1e6 + 0.5e0) / 1e6 as score
from g left join e using (word, p) group by doc_id""")
def sentiment_tagged(spark, sf):
    tokens = tokenize(documents(spark, sf), "doc_id", "text").selectExpr("doc_id", "pos", "word", f"{TAG} as tag")
    scored_docs = tagged_scores(tokens, "doc_id", document_lexicon(settle(document_words(spark, sf))))
    return scored_docs.select("doc_id", half_up(F.col("score")).alias("score"))


# A word's entries are numbered senses; a second entry of the same part of speech comes first for words of odd length.
FIRST_SENSE = "1 + length(word) % 2 * 2"
OTHER_UP = "cast(length(word) * 5 % 8 as double) / 8"
OTHER_DOWN = "cast(ascii(word) * 3 % 8 as double) / 8"


@query(f"""with {SCORES},
senses as (select word, pos as p, up, down, {FIRST_SENSE} as sense from lexicon
           union all select word, {POS}, {OTHER_UP}, {OTHER_DOWN}, 2 from vocab_words),
e as (select word, p, up - down as delta from senses where p in ('n', 'a', 'r')
      qualify row_number() over (partition by word, p order by sense, up desc, down) = 1),
g as (select doc_id, pos, tok.word, delta, length(tok.word) <= 2 as is_stop, tok.word in ({NEGATION_LIST}) as is_neg
      from tok left join e on e.word = tok.word
          and e.p = case pos % 4 when 0 then 'n' when 1 then 'a' when 2 then 'r' else 'v' end),
seen as (select *, sum(is_neg::int) over (partition by doc_id order by pos) as c from g),
first_of as (select *, coalesce(lag(c) over (partition by doc_id order by pos), 0) as before from seen where delta is not null and not is_neg),
turned as (select doc_id, sum(case when (c - before) % 2 = 1 then -delta else delta end) / count(*) as negated from first_of group by doc_id)
select g.doc_id, floor(coalesce(sum(delta) / count(delta), 0) * 1e6 + 0.5e0) / 1e6 as score,
    floor(coalesce(sum(delta) filter (where not is_stop) / nullif(count(delta) filter (where not is_stop), 0), 0) * 1e6 + 0.5e0) / 1e6 as score_no_stop,
    floor(coalesce(max(negated), 0) * 1e6 + 0.5e0) / 1e6 as score_negated
from g left join turned using (doc_id) group by g.doc_id""")
def sentiment_senses(spark, sf):
    """Tagged tokens against a lexicon with several senses a word: plain, without stop words, and with negation."""
    words = settle(document_words(spark, sf))
    first = document_lexicon(words).withColumn("sense", F.expr(FIRST_SENSE))
    other = words.selectExpr("word", f"{POS} as pos", f"{OTHER_UP} as pos_score", f"{OTHER_DOWN} as neg_score", "2 as sense")
    tokens = tokenize(documents(spark, sf), "doc_id", "text").selectExpr("doc_id", "pos", "word", f"{TAG} as tag")
    found = tagged_scores(tokens, "doc_id", first.unionByName(other), words.filter("length(word) <= 2"))
    return found.withColumns({c: half_up(F.col(c)) for c in ("score", "score_no_stop", "score_negated")})


WAYS = (("score", 0.1), ("score_no_stop", 0.1), ("score_negated", 0.1), ("score", 0.2), ("score", 0.05), ("compound", 0.05))
ALL_LABELS = ", ".join(f"{label_sql(s, t)} as {n}" for n, (s, t) in zip(LABEL_COLUMNS, WAYS))
GOLD = "case quality when 1 then 'positive' when 0 then 'negative' else 'Unknown' end"
CLASSIFIED = f"""{SCORES},
classified as (select doc_id, {GOLD} as gold, {ALL_LABELS} from scored left join labels using (doc_id))"""


def gold_documents(spark, sf):
    judged = spread(table(spark, sf, "documents"), "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return judged.selectExpr("doc_id", "text", f"{GOLD} as gold")


@query(f"with {CLASSIFIED} select doc_id, {', '.join(LABEL_COLUMNS)} from classified")
def sentiment_all(spark, sf):
    return labels(scored(spark, sf), "doc_id")


@query(f"""with {CLASSIFIED}
select doc_id, {', '.join(f"cast(coalesce({c} = gold, false) as integer) as {c}_is_matching" for c in LABEL_COLUMNS)} from classified""")
def sentiment_match_flags(spark, sf):
    rows = add_labels(gold_documents(spark, sf), "text", document_vocabulary(spark, sf))
    return match_flags(rows, "gold").select("doc_id", *[f"{c}_is_matching" for c in LABEL_COLUMNS])


@query(f"""with {CLASSIFIED}, k as (select * from classified where gold <> 'Unknown')
{" union all ".join(f'''select '{c}' as classifier, count(*) filter (where {c} = gold) as matches, count(*) as total,
round(cast(count(*) filter (where {c} = gold) as double) * 100 / count(*), 6) as accuracy from k''' for c in LABEL_COLUMNS)}""")
def sentiment_accuracy(spark, sf):
    rows = add_labels(gold_documents(spark, sf), "text", document_vocabulary(spark, sf))
    return accuracy(rows, "gold").withColumn("accuracy", r6("accuracy"))
