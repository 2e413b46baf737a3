"""Operators that SQL cannot express, against brute force or an exact round trip."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tallywing.llm import common, language, lattice, packing, partenum, suffixes
from tallywing.llm.graph import components

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def copies(rng, n_words=120, groups=6, size=8):
    """Groups of near copies of different distance, exact copies, and texts with a common passage."""
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(800)]
    passage, out = rng.choices(vocabulary, k=60), []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(6, n_words))
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        out.append(out[-1].upper())
    out += [" ".join(passage + rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(25)]
    return out + ["tiny", "tiny", "one two", "a b c d e", "a b c d e f"]


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_join(spark, monkeypatch, seed):
    monkeypatch.setattr(partenum, "PAIRS_PER_ROW", seed - 1)  # with and without hub rounds
    rng = random.Random(seed)
    rows = list(enumerate(copies(rng)))
    rng.shuffle(rows)
    got = partenum.link_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == brute_components(rows)


def test_linked_sets_share_a_signature():
    """All sizes and the largest difference a link allows, half of it on either side."""
    rng = np.random.default_rng(0)
    for m in [*range(1, 80), 121, 243, 244, 400, 729, 1500]:
        for drop in range(0, m // 5 + 1, max(1, m // 25)):
            s = np.unique(rng.integers(0, 2**63, m).astype(np.uint64) * np.uint64(2))
            kept = s[rng.permutation(len(s))[: len(s) - drop]]
            for add in {0, max(0, (100 * len(kept) // 80) - len(s))}:
                t = np.unique(np.r_[kept, rng.integers(0, 2**63, add).astype(np.uint64) * np.uint64(2) + np.uint64(1)])
                common = len(np.intersect1d(s, t))
                if 100 * common >= 80 * (len(s) + len(t) - common):
                    assert len(np.intersect1d(partenum.signatures(s), partenum.signatures(t))), (m, drop, add)


def test_similarity_join_edges(edge):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in partenum.link_components(edge).collect())
    assert got[1, 6, 1] == 2 and got[None, 6, 1] == 1 and got[2, 0, 2] == 1 and got[4, 0, 4] == 1
    kept = partenum.keep_one(edge)
    assert kept.columns == edge.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} >= {(2, None), (3, "")} and kept.filter("doc_id is null").count() == 0
    assert partenum.link_components(edge.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark, edge):
    """Repeated rows, near copies under one id, and groups without any id: one row each."""
    kept = Counter((r.doc_id, r.text) for r in partenum.keep_one(edge).collect())
    assert max(kept.values()) == 1 and sum(kept.values()) == edge.count() - 2 and (1, edge.first().text) in kept
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " end", " ".join(f"v{i}" for i in range(60))
    rows = [(1, base, 1), (1, base, 2), (1, base, 2), (1, near, 1), (2, near, 1), (None, base, 1),
            (None, other, 1), (None, other, 1), (None, other + " end", 1), (7, None, 1), (7, None, 1), (None, "", 1), (None, "", 1)]
    got = sorted(map(tuple, partenum.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect()), key=str)
    full = [r for r in got if r[1]]
    assert len(full) == 2 and {r[0] for r in full} == {1, None} and len(got) == 6
    assert all(r == (1, base, 1) or r == (1, near, 1) for r in full if r[0]) and all(r[1].startswith(other) for r in full if not r[0])


def test_components_of_a_long_path(spark):
    n = 200
    order = list(range(n))
    random.Random(4).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001)], "a long, b long")
    got = {(r.node, r.label) for r in components(links).collect()}
    assert got == {(i, 0) for i in range(n)} | {(1000, 1000), (1001, 1000)}


def brute_removed(rows):
    data = [(d, (t or "").encode()) for d, t in rows]
    counts = Counter(b[i : i + suffixes.LENGTH] for _, b in data for i in range(len(b) - suffixes.LENGTH + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - suffixes.LENGTH + 1):
            if counts[b[i : i + suffixes.LENGTH]] > 1:
                gone[i : i + suffixes.LENGTH] = True
        kept = bytes(np.frombuffer(b, dtype=np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("alphabet, ranges", [("abcdefgh ", 50_000), ("ab", 7)])
def test_suffix_dedup(spark, monkeypatch, alphabet, ranges):
    monkeypatch.setattr(suffixes, "RANGE", ranges)  # many ranges: neighbours across their ends
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [text(n) for n in (399, 400, 401, 450, 700, 1500)]
    rows = [(i, text(rng.randint(0, 300)) + rng.choice(shared) + text(rng.randint(0, 300)) + rng.choice(shared)) for i in range(30)]
    # Long agreement before or after the same place, but not on both sides; runs of one byte; near copies.
    rows += [(100 + i, text(50) + shared[5][i * 17 : i * 17 + 410] + text(60)) for i in range(30)]
    rows += [(200, "x" * 900), (201, "é" * 300 + "x" * 399), (202, None), (203, ""), (204, shared[4]), (205, shared[4])]
    rows += [(300 + i, shared[5][: 700 + i] + "#" + shared[5][701 + i :]) for i in range(12)]
    got = suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute_removed(rows)


def test_a_hot_suffix_spans_ranges(spark, monkeypatch):
    """A passage after different text in every document: equal suffixes are dealt to ranges of bounded size."""
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(150)) + passage) for i in range(120)]
    lists = []
    for _, t in rows:
        data = t.encode()
        found = [(a, lo, hi) for a, lo, hi in zip(*(x.tolist() for x in suffixes.anchors(data))) if lo < 150 <= a]
        lists.append((data, [{"at_": a, "first_": lo, "last_": hi, "context_": hashlib.md5(data[lo : hi + 400]).digest()} for a, lo, hi in found]))
    frame = suffixes.pd.DataFrame(lists, columns=["data_", "places_"])
    picked = sorted(i[:2] for i in suffixes._items([frame]))
    assert len(picked) >= 100 and len({s for s, _ in picked}) <= 3 and len(set(picked)) == len(picked)
    out = suffixes.pd.concat(suffixes._runs(suffixes.range_bounds(picked, 12))([frame]))
    sizes = [len(suffixes.pickle.loads(suffixes.zlib.decompress(r))[0]) for r in out["run_"]]
    assert len(set(out["range_"])) == 12 and sum(sizes) == len(picked) and max(sizes) <= len(picked) // 12 + 1
    monkeypatch.setattr(suffixes, "RANGE", 10)
    monkeypatch.setattr(suffixes, "PIECE", 7)
    got = suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute_removed(rows)
    pieces = list(suffixes._strings(iter([out[out["range_"] == 5]])))
    assert len(pieces) > 1 and max(map(len, pieces)) <= 7 + suffixes.WINDOW


def near_copies(n):
    rng = random.Random(5)
    body = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    return [(i, body[: 600 + 7 * i] + f"<{i}>" + body[600 + 7 * i :]) for i in range(n)]


def test_suffix_strings_are_counted_in_their_range():
    """Only strings at a range's ends leave it one by one; of the others a context's distances do."""
    lists = []
    for _, t in near_copies(40):
        data = t.encode()
        found = zip(*(x.tolist() for x in suffixes.anchors(data)))
        lists.append((data, [{"at_": a, "first_": lo, "last_": hi, "context_": hashlib.md5(data[lo : hi + 400]).digest()} for a, lo, hi in found]))
    frame = suffixes.pd.DataFrame(lists, columns=["data_", "places_"])
    out = suffixes.pd.concat(suffixes._runs([])([frame]))
    strings = suffixes.pd.concat(suffixes._strings(iter([out])))
    assert len(strings) < sum(len(places) for _, places in lists) + 2 * suffixes.WINDOW


@pytest.mark.parametrize("listed, held", [(4_000_000, 500_000), (4_000_000, 3), (0, 50)])
def test_suffix_dedup_ways(spark, monkeypatch, listed, held):
    """Places found again in their texts or joined to them, and strings that are more than a task holds."""
    monkeypatch.setattr(suffixes, "LISTED", listed)
    monkeypatch.setattr(suffixes, "HELD", held)
    rows = near_copies(25)
    got = suffixes.drop_repeated_strings(spark.createDataFrame(rows + rows[:2], "doc_id long, text string")).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute_removed(rows + rows[:2])


def test_suffix_dedup_edges(spark, edge):
    got = suffixes.drop_repeated_strings(edge)
    assert got.count() == edge.count()
    row = spark.createDataFrame([(1, "q" * 10 + "".join(map(str, range(500))))] * 2, "doc_id long, text string")
    assert all(r.n_removed == r.n_bytes > 400 and r.n_spans == 1 for r in suffixes.drop_repeated_strings(row).collect())
    text, other = "".join(map(str, range(900, 1200))), "".join(map(str, range(300)))
    rows = [(None, text), (None, text), (None, other), (3, other[:399]), (3, other[:399]), (4, text + "tail"), (None, None), (None, None)]
    got = suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.n_bytes, r.n_removed) for r in got.collect()) == sorted(
        [(len(text), len(text))] * 2 + [(len(other), 0), (399, 0), (399, 0), (len(text) + 4, len(text)), (0, 0), (0, 0)])
    assert suffixes.drop_repeated_strings(edge.limit(0)).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 50))) for _ in range(k)]
        out = list(suffixes.merged([suffixes.decoded(*suffixes.front_coded(r), [None] * len(r)) for r in runs]))
        assert [x[0] for x in out] == sorted(itertools.chain(*runs))
        assert all(q[1] == suffixes.common(p[0], q[0], 0) for p, q in itertools.pairwise(out))


def check_packing(rows, pieces):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter()
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END]
        want[d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0) == Counter((d, n) for d, n, _ in want.elements())
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.length > 0 and filled.get(p.sequence_id, 0) == p.offset
        filled[p.sequence_id] = p.offset + p.length
    assert max(filled.values()) <= packing.CAPACITY
    assert sum(filled.values()) == sum(n * c for (_, n, _), c in want.items())
    return sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in filled.values()) / sum(filled.values())


def test_packing(spark, documents, edge):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    pieces = packing.pack(documents, WORDS).collect()
    assert check_packing(rows, pieces) < 0.02
    from tokenizers import Tokenizer
    tokenizer, by_doc = Tokenizer.from_file(WORDS), {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for d, t in rows:
        ids, at = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], dtype="<u4"), 0
        for p in sorted(by_doc[d], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    check_packing([(r.doc_id, r.text) for r in edge.collect()], packing.pack(edge, WORDS).collect())
    assert packing.pack(edge.limit(0), WORDS).count() == 0


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    texts = ["It's don't I'LL 's'd, x's.", "Ünïcode Ä́ É. ǅ İstanbul ΣΑΣ 東京!? 😀.", "a b c \x1c d", "<|endoftext|> <|ENDOFTEXT|>a.",
             "12,345.67 ... ?!.. a.b.c. --- foo_bar, (x); “q”.", "é. ́ x‍", None, "", "''s 'S 'Re,"]
    assert encoder.texts(texts) == [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def test_language(spark, documents, edge):
    joined = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(joined) > 20 and sum(r.lang == r.lang_pred for r in joined) >= 0.95 * len(joined)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(edge).collect()}
    assert {(2, "und"), (3, "und"), (4, "und")} <= got
    assert all(r.lang_pred == "und" for r in language.identify(edge.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect())
    assert language.identify(edge.limit(0)).count() == 0
    names, counts = language.grams("ab a")
    assert sorted(counts.tolist()) == sorted(Counter([*"aba", " a", "ab", "b ", " a", "a ", " ab", "ab ", " a "]).values()) and len(names) == 9


def test_scores(spark, documents, edge):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    train, got = Counter(), {r.doc_id: r for r in lattice.score_texts(documents, PIECES).collect()}
    tokens = {d: [*(t or "").encode().lower().split(), None] for d, t in rows}
    for d, ts in tokens.items():
        if zlib.crc32(str(d).encode()) % 10:
            train.update(ts)
    total, distinct = sum(train.values()), len(train)
    for d, ts in tokens.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(train[t] > 0 for t in ts), total)
        assert math.isclose(r.base_score, sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in ts), rel_tol=1e-9)
    assert all(r.score < 0 for r in got.values())
    assert lattice.score_texts(edge, PIECES).count() == edge.count()
    assert lattice.score_texts(edge.limit(0), PIECES).count() == 0


def test_lattice_sums_all_segmentations():
    weights = {p: math.log(w) for p, w in {"▁": 0.1, "a": 0.2, "b": 0.1, "ab": 0.15, "▁a": 0.05, "▁ab": 0.02, "ba": 0.1, "<0xC3>": 0.01, "<0xA9>": 0.01}.items()}

    def every(text):
        if not text:
            return 1.0
        total = sum(math.exp(w) * every(text[len(p):]) for p, w in weights.items() if text.startswith(p))
        return total + (1e-4 * every(text[1:]) if text[0] == "é" else 0)

    for word in ("ab", "abba", "éa", "baab"):
        assert math.isclose(lattice.Lattice(weights).score(word), math.log(every("▁" + word)), rel_tol=1e-12)


@pytest.mark.parametrize("operator", [lambda d: packing.pack(d, WORDS), lambda d: partenum.link_components(d)])
def test_workers_get_texts_in_short_batches(spark, operator):
    """Before, a worker got up to 64 MB of texts at once, and held them several times."""
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    long_texts = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat(cast(id as string), 3000) as text")
    try:
        spark.conf.unset(limit)
        operator(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
        found = [r.n for r in long_texts.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 4 * common.BATCH_BYTES and max(found) < 2 * common.BATCH_BYTES
        spark.conf.set(limit, "1m")  # the user's own setting stays
        operator(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
        assert spark.conf.get(limit) in ("1m", "1048576", "1048576b")
    finally:
        spark.conf.unset(limit)


def test_workers_remember_no_more_than_asked(monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(60)]
    plain, short = packing.WordEncoder(WORDS), packing.WordEncoder(WORDS, 100)
    assert [x for t in texts for x in short.texts([t])] == plain.texts(texts)
    assert len(short.recent) <= 150 and len(short.older) <= 150 and len(plain.recent) >= 3000
    monkeypatch.setattr(partenum, "KNOWN_ELEMENTS", 100)
    sets = partenum.Sets()
    for i, t in enumerate(texts * 2):
        assert list(sets.of(i % 60, t)) == list(partenum.Shingles().of(t))
        assert sets.held == sum(map(len, sets.sets.values())) <= 100
