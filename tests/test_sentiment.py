import math
import random

import pytest

from tallywing.constants import LABEL_COLUMNS, NEGATIONS
from tallywing.operators import sentiment as S

LEXICON = [("good", "a", 1.0, 0.0), ("bad", "a", 0.0, 1.0), ("run", "v", 1.0, 0.0), ("fair", "a", 0.5, 0.125),
           ("fair", "n", 0.0, 0.75), ("no", "r", 0.0, 0.625), ("the", "n", 0.5, 0.0)]
SCHEMA = "word string, pos string, pos_score double, neg_score double"


@pytest.fixture
def vocab(table):
    stops = table([("the",), ("no",)], "word string")
    valences = table([("good", 1.9), ("bad", -2.5), ("great", 3.1)], "word string, valence double")
    return S.vocabulary(table(LEXICON, SCHEMA), stops, valences)


def fold(text, skip=()):
    """The plain left-to-right rule, one text at a time."""
    delta = {"good": 1.0, "bad": -1.0, "fair": -0.75, "no": -0.625, "the": 0.5}
    total, n, flag = 0.0, 0, False
    for word in text.split():
        if word in NEGATIONS:
            flag = not flag
        elif word in delta and word not in skip:
            total += -delta[word] if flag else delta[word]
            n, flag = n + 1, False
    return total / n if n else 0.0


def test_vocabulary_keeps_scoring_words_once(vocab, rows):
    assert rows(vocab, "word", "delta", "is_stop", "valence") == [
        ("bad", -1.0, False, -2.5), ("fair", -0.75, False, None), ("good", 1.0, False, 1.9), ("great", None, None, 3.1),
        ("no", -0.625, True, None), ("the", 0.5, True, None),
    ]


def test_scores_of_single_texts(table, vocab):
    texts = ["good not good not not bad", "xyz", "", None, "the good", "no good", "good run", "not the not good", "GOOD, great!"]
    df = table(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r for r in S.scores(df, "id", "text", vocab).collect()}
    assert len(got) == len(texts)
    assert got[0]["score_negated"] == pytest.approx((1 - 1 - 1) / 3)
    assert [got[1][c] for c in ("score", "score_no_stop", "score_negated", "compound")] == [0, 0, 0, 0]
    for empty in (2, 3):
        assert [got[empty][c] for c in ("score", "score_no_stop", "score_negated", "compound")] == [None] * 4
    assert (got[4]["score"], got[4]["score_no_stop"]) == (0.75, 1.0)
    assert (got[5]["score"], got[5]["score_no_stop"], got[5]["score_negated"]) == (0.1875, 1.0, -1.0)
    assert got[6]["score"] == 1.0
    assert got[7]["score_negated"] == fold("not the not good") == (-0.5 - 1.0) / 2
    assert got[8]["compound"] == pytest.approx(5.0 / math.sqrt(25 + 15))


def test_negation_agrees_with_the_left_to_right_rule(table, vocab):
    rng = random.Random(11)
    alphabet = [*NEGATIONS, "good", "bad", "fair", "the", "filler", "notable", "know", "can't"]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    df = table(list(enumerate(texts)), "id int, text string")
    for parts in (1, 8):
        got = {r["id"]: r["score_negated"] for r in S.scores(df.repartition(parts), "id", "text", vocab).collect()}
        assert all(got[i] == pytest.approx(fold(t), abs=1e-12) for i, t in enumerate(texts))


def test_large_vocabulary_goes_the_shuffled_way(table, vocab, monkeypatch, rows):
    df = table([(i, "not good the bad no great good") for i in range(20)], "id int, text string")
    expected = rows(S.scores(df, "id", "text", vocab))
    monkeypatch.setattr("tallywing.operators.joins.fits_broadcast", lambda *a, **k: False)
    assert rows(S.scores(df, "id", "text", vocab)) == expected


def test_large_vocabulary_moves_rare_words_only(table, vocab, monkeypatch, rows, spark):
    """Beyond the broadcast bound no token is written, and the frequent words' tokens are joined where they are."""
    df = table([(i, f"not good the bad no great good once{i}") for i in range(20)] + [(20, "bad not fair"), (21, "lonely"), (22, None)], "id int, text string")
    expected = rows(S.scores(df, "id", "text", vocab))
    monkeypatch.setattr("tallywing.operators.joins.fits_broadcast", lambda *a, **k: False)
    written = []
    monkeypatch.setattr("tallywing.operators.skew.stage", lambda table, name: written.append(name) or table)
    out = S.scores(df, "id", "text", vocab)
    assert rows(out) == expected and not written
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    tokens = table([(1, 0, "Fair", "JJ"), (1, 1, "fair", "JJ"), (2, 0, "fair", "NNS"), (2, 1, None, "VB"), (3, 0, "xyz", "DT"), (4, 0, "good", "JJ")],
                   "id int, pos int, word string, tag string")
    found = S.tagged_scores(tokens, "id", table(LEXICON, SCHEMA))
    assert rows(found, "id", "score") == [(1, 0.375), (2, -0.75), (3, 0.0), (4, 1.0)] and not written


def test_labels_and_accuracy(table, vocab, rows):
    df = table(
        [(1, "good", "positive"), (2, "bad", "positive"), (3, "bad", None), (4, "bad", "Unknown"), (5, None, "negative")],
        "id int, text string, gold string",
    )
    out = S.match_flags(S.add_labels(df, "text", vocab), "gold")
    assert rows(out, "id", "sentiment", "sentiment_is_matching") == [
        (1, "positive", 1), (2, "negative", 0), (3, "negative", 0), (4, "negative", 0), (5, None, 0)
    ]
    result = {r["classifier"]: r for r in S.accuracy(out, "gold").collect()}
    assert set(result) == set(LABEL_COLUMNS)
    assert (result["sentiment"]["matches"], result["sentiment"]["total"]) == (1, 3)
    assert result["sentiment"]["accuracy"] == pytest.approx(100 / 3)
    assert S.accuracy(out.filter("id = 3"), "gold").first()["accuracy"] is None


def test_user_classifier_skips_empty_texts(table, rows):
    df = table([(1, "abc"), (2, ""), (3, None)], "id int, text string")
    out = S.classify_with(df, "text", lambda t: t.str.upper(), "mine")
    assert rows(out, "id", "mine") == [(1, "ABC"), (2, None), (3, None)]
    assert "ArrowEvalPython" in out._jdf.queryExecution().toString()


def test_tagged_words_score_by_their_tag(table, rows):
    tokens = table(
        [(1, 0, "Fair", "JJ"), (1, 1, "fair", "NN"), (2, 0, "fair", "NNS"), (2, 1, "good", "VB"), (3, 0, "xyz", "DT")],
        "id int, pos int, word string, tag string",
    )
    found = S.tagged_scores(tokens, "id", table(LEXICON, SCHEMA))
    assert rows(found, "id", "score") == [(1, (0.375 - 0.75) / 2), (2, -0.75), (3, 0.0)]


def test_tagged_negation_and_stop_words_by_the_left_to_right_rule(table):
    rng, delta = random.Random(3), {"good": 1.0, "bad": -1.0, "the": 0.5}
    texts = [[rng.choice([*NEGATIONS, "good", "bad", "the", "filler"]) for _ in range(rng.randint(1, 25))] for _ in range(120)]
    lexicon = [(w, "a", max(d, 0.0), max(-d, 0.0)) for w, d in delta.items()] + [("not", "a", 1.0, 0.0)]
    tokens = table([(i, p, w, "JJ") for i, t in enumerate(texts) for p, w in enumerate(t)], "id int, pos int, word string, tag string")
    got = {r.id: r for r in S.tagged_scores(tokens, "id", table(lexicon, SCHEMA), table([("the",)], "word string")).collect()}
    for i, text in enumerate(texts):
        total, n, flag = 0.0, 0, False
        for word in text:
            if word in NEGATIONS:
                flag = not flag
            elif word in delta:
                total, n, flag = total + (-delta[word] if flag else delta[word]), n + 1, False
        assert got[i].score_negated == pytest.approx(total / n if n else 0.0)
        kept = [{**delta, "not": 1.0}[w] for w in text if w in delta and w != "the" or w == "not"]
        assert got[i].score_no_stop == pytest.approx(sum(kept) / len(kept) if kept else 0.0)


def test_the_first_sense_counts(table, rows):
    lexicon = table([("fair", "a", 1.0, 0.0, 2), ("fair", "a", 0.25, 0.5, 1), ("fair", "n", 1.0, 0.0, 1), ("odd", "n", 0.5, 0.0, 1), ("odd", "n", 0.5, 0.25, 1)],
                    SCHEMA + ", sense int")
    assert rows(S.vocabulary(lexicon), "word", "delta") == [("fair", 1.0), ("odd", 0.5)]
    tokens = table([(1, 0, "fair", "JJ"), (2, 0, "odd", "NN")], "id int, pos int, word string, tag string")
    assert rows(S.tagged_scores(tokens, "id", lexicon), "id", "score") == [(1, -0.25), (2, 0.5)]


def test_labels_move_no_text(spark, table, vocab):
    """From the scan of the texts to the joined rows there is no exchange, neither for tokens nor for the join back."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = table([(i, "good not bad " * 5, "x") for i in range(50)], "id int, text string, task_ string").repartition(3)
        out = S.add_labels(df, "text", S.F.broadcast(vocab))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["id", "text", "task_", *LABEL_COLUMNS] and out.count() == 50
    assert "ShuffledHashJoin" in plan and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(_task_" not in plan and "Exchange hashpartitioning(task_" not in plan


def test_tokens(table, rows):
    df = table([(1, "One, two\none")], "id int, text string")
    assert rows(S.tokenize(df, "id", "text")) == [(1, 0, "one"), (1, 1, "two"), (1, 2, "one")]


def test_tokens_that_no_entry_can_have_are_not_looked_up(table, monkeypatch):
    """Verbs and tags without a part of speech have no key, so they are neither counted nor shuffled."""
    seen, join = [], S.join_by_frequency
    monkeypatch.setattr(S, "join_by_frequency", lambda facts, *more: seen.append(facts) or join(facts, *more))
    tokens = table([(1, 0, "good", "JJ"), (1, 1, "run", "VBD"), (1, 2, "no", "XX"), (1, 3, "fair", "NN")], "id long, pos long, word string, tag string")
    (got,) = S.tagged_scores(tokens, "id", table(LEXICON, SCHEMA)).collect()
    assert {r["_word"]: r["_pos"] for r in seen[0].collect()} == {"good": "a", "run": None, "no": None, "fair": "n"}
    assert (got.score, got.score_negated) == (0.125, 0.875)
