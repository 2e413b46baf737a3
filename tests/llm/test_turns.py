"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from tallywing.llm import turns

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "fine")
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest edits of one conversation's rows (turn, role, text): every choice of edits with up to two insertions a gap."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    wrong, best = faults(rows), None
    for edits in product("DKR", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(wrong, edits)):
            continue
        paid = sum({"D": 2, "K": 0, "R": 1}[e] + (5 if f == "cut" and e != "D" else 0) for e, f in zip(edits, wrong))
        for gaps in product(range(3), repeat=len(rows) + 1):
            cost = paid + 5 * sum(gaps)
            if best is not None and cost > best[0]:
                continue
            letters = [c for g, e in zip(gaps, [*edits, ""]) for c in "I" * g + e]
            for given in product("ua", repeat=sum(c in "IR" for c in letters)):
                names, left, out = iter(given), iter(rows), []
                for c in letters:
                    row = next(left) if c != "I" else None
                    if c == "K":
                        out.append((row[1], row[2]))
                    elif c != "D":
                        out.append(({"u": "user", "a": "assistant"}[next(names)], row[2] if row else ""))
                if LEGAL.match("".join(r[:1] or "-" for r, _ in out)):
                    found = (cost, "".join(letters), "\n".join(f"{r}:{t}" for r, t in out))
                    best = found if best is None else min(best, found)
    return best


def summary(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    wrong, numbers = faults(rows), [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, text = brute(rows)
    return (gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("cut"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def random_rows(rng, n):
    texts = ["Yes.", "No!", "cut here", " ", "", "What?", "é…"]
    return [(rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["user", "assistant", "system", "tool", " ", ""]), rng.choice(texts)) for _ in range(n)]


def test_repair_as_brute_force(spark):
    rng = random.Random(11)
    talks = {i: random_rows(rng, rng.randint(0, 5)) for i in range(60)}
    talks[None] = [(1, "user", "Hi."), (2, "assistant", "Ho.")]
    rows = [(c, *r, True) for c, rs in talks.items() for r in rs] + [(c, 0, "user", "gone.", False) for c in talks]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, live boolean")
    found = {r[0]: tuple(r)[1:] for r in turns.repair(df, live_col="live").collect()}
    assert found == {c: summary(rs) for c, rs in talks.items()}


def test_giant_conversation_spills(spark, monkeypatch):
    """Backpointers and digests beyond memory's share; batches far smaller than the conversation."""
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"Line {i}.", f"cut {i % 50}", " "])) for i in range(3000)]
    talk, plain = turns.Conversation(), turns.Conversation()
    for _, turn, role, text in rows:
        plain.add(turn, role, text)
    monkeypatch.setattr(turns, "SPILL", 1000)
    monkeypatch.setattr(turns, "HELD", 50)
    small = turns.Conversation()
    for _, turn, role, text in rows:
        small.add(turn, role, text)
    assert len(small.seen.runs) >= 1 and len(small.seen.runs) < 12
    want = plain.end()
    assert small.end() == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        assert tuple(turns.repair(df).first())[1:] == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert talk.end() == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [] if fault == 0 else [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def test_damage(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, *range(60)]), rng.choice([None, "user", "system"]), rng.choice([None, "A. b!", ""]))
            for _ in range(300)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, fault_ long, copy_ long")
    found = turns.damage(df)
    assert set(df.columns) < set(found.columns)
    live = [tuple(r) for r in found.filter("live").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(live, key=str) == sorted(damaged(rows), key=str)
    assert found.filter("not live").count() == sum(zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 == 0 for c, t, _, _ in rows)


@pytest.mark.parametrize("turn", [(-(1 << 63), (1 << 63) - 1)])
def test_edges(spark, turn):
    df = spark.createDataFrame([(1, turn[0], "user", "a."), (1, turn[1], "assistant", None), (2, None, None, None), (2, None, None, None)],
                               "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in turns.repair(df.selectExpr("*", "1 as conv", "2 as live")).collect()}
    assert found[1].gaps == (1 << 63) - 1 and found[1].blank == 1
    assert (found[2].gaps, found[2].blank, found[2].illegal, found[2].audit) == (0, 2, 1, "DD")
    assert turns.repair(df.limit(0)).count() == 0
