"""Removal of long repeated byte strings by a prefix-aware distributed merge sort of suffixes.

Every byte that a string of ``LENGTH`` bytes covers goes when that string starts anywhere else, too. Suffixes
are not sorted at every position but at anchors: the start of a string hands over to the place of the least
hash among its first ``WINDOW`` places, which depends on the string alone, so equal strings have equal anchors
at equal distances. An anchor stands for a run of starts; its context is all their bytes.

1. The first ``LENGTH - WINDOW + 1`` bytes from an anchor are counted by hash; anchors that share them with
   no other cannot matter. The others are counted by context: strings of a context that occurs twice repeat.
2. Of every context one copy is sorted by its suffix from the anchor. Tasks sort runs and send them
   front-coded, dealt to ranges whose bounds are sampled; per range a loser tree merges them, and uses the
   lengths of common prefixes, so that known prefixes are never compared again.
3. Neighbours in that order tell how far a context agrees with any other one. Contexts that hold one string stand
   next to each other, so strings that can repeat by that are counted in the task, while it passes them, by a
   128-bit hash, which settles the bytes before the anchor. Only of strings that can also stand beyond a range's
   ends (or were met while ``HELD`` others were open) one row each is left to be counted among ranges.

Texts are not shuffled for that: tasks find the contexts to sort again by their places, which are broadcast up to
``LISTED`` of them; beyond that the documents are joined to lists of them.

A range has about ``RANGE`` contexts, and the sample for its bounds grows with the number of ranges: it can end between suffixes that agree for long, and between equal ones,
which the hash of the context puts in an order (a passage after different text gives one context for each
document, all with the same suffix). Strings leave a range in pieces. Defined results: null text is empty; texts shorter
than ``LENGTH`` never change; rows that repeat are documents of their own, also under one id or null ids, so such a
row of ``LENGTH`` bytes or more loses all of them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import as_array, release, row_key, small, within

LENGTH, WINDOW, GRAM = 400, 128, 24
LEAST = LENGTH - WINDOW + 1
RANGE, SAMPLE, RUN_BYTES, PIECE = 50_000, 4000, 24 << 20, 100_000
#: Sampled suffixes for each range.
PER_RANGE = 8
#: Strings counted at a time while a range is merged.
HELD = 500_000
#: Rows up to which lists of hashes or of places are broadcast.
LISTED = 4_000_000
_BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 2**64))


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text, each with the first and last start that hands over to it."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, dtype=np.int64),) * 3
    h, width = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1), 1
    while width < 16:
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
        if width == 8:
            eight = h
    h = h[: len(h) - 8] * _power(8) + eight[16 : 8 + len(h)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    # High bits of the hash, then the place: the least is the leftmost of equal ones.
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < WINDOW:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    place = (key[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[first], first, np.r_[first[1:] - 1, n - 1]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row_key(id_col, text_col).alias("key_"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data_"))


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every anchor the hash of the bytes that all its strings have."""
    for batch in batches:
        for at in range(0, len(batch), 64):
            heads = [_head(bytes(d), a) for d in batch["data_"].iloc[at : at + 64] for a in anchors(bytes(d))[0].tolist()]
            yield pd.DataFrame({"head_": np.array(heads, dtype=np.int64)})


def _head(data: bytes, a: int) -> int:
    return xxhash.xxh3_64_intdigest(data[a : a + LEAST]) - (1 << 63)


def _context(data: bytes, a: int, lo: int, hi: int) -> bytes:
    return xxhash.xxh3_128_digest(data[lo : hi + LENGTH], seed=a - lo)


def _places(often: Broadcast | None):
    """Every anchor, or those whose head is listed: ``key_``, ``at_``, ``first_``, ``last_``, ``head_``, hash of its context."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                out = []
                for key, data in zip(batch["key_"].iloc[at : at + 64], batch["data_"].iloc[at : at + 64]):
                    data = bytes(data)
                    places, first, last = anchors(data)
                    heads = np.array([_head(data, a) for a in places.tolist()], dtype=np.int64)
                    hit = np.ones(len(heads), dtype=bool) if often is None else within(often.value, heads)
                    for a, lo, hi, head in zip(*(x[hit].tolist() for x in (places, first, last, heads))):
                        out.append((key, a, lo, hi, head, _context(data, a, lo, hi)))
                yield pd.DataFrame(out, columns=["key_", "at_", "first_", "last_", "head_", "context_"])

    return run


PLACES = "key_ long, at_ long, first_ long, last_ long, head_ long, context_ binary"


def common(x: bytes, y: bytes, start: int) -> int:
    """Length of the common prefix, of which ``start`` bytes are known."""
    low, high = start, min(len(x), len(y))
    if x[low:high] == y[low:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid
    return low


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Common prefix with the string before, and the rest."""
    lcps, rests, before = [], [], b""
    for s in strings:
        n = common(before, s, 0)
        lcps.append(n)
        rests.append(s[n:])
        before = s
    return lcps, rests


def decoded(lcps: list[int], rests: list[bytes], payload: list) -> Iterator[tuple[bytes, int, tuple]]:
    before = b""
    for n, rest, extra in zip(lcps, rests, payload):
        before = before[:n] + rest
        yield before, n, extra


def merged(runs: list[Iterator[tuple[bytes, int, tuple]]]) -> Iterator[tuple[bytes, int, tuple]]:
    """Strings of all runs in order, each with its common prefix with the one before, by a loser tree."""
    k = len(runs)
    text, lcp, extra = [None] * k, [0] * k, [None] * k

    def advance(j: int) -> None:
        item = next(runs[j], None)
        text[j], lcp[j], extra[j] = item if item else (None, 0, None)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix is then relative to the winner."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        n = common(x, y, lcp[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        lcp[b if first else a] = n
        return (a, b) if first else (b, a)

    for j in range(k):
        advance(j)
        lcp[j] = 0
    losers, winners = [-1] * (2 * k), list(range(-k, k))
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while text[top] is not None:
        yield text[top], lcp[top], extra[top]
        advance(top)
        node = (top + k) // 2
        while node >= 1 and k > 1:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _items(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Suffix from the anchor, hash of the context, bytes before the anchor."""
    for batch in batches:
        for data, places in zip(batch["data_"], batch["places_"]):
            data = bytes(data)
            for p in places:
                a, lo, hi = p["at_"], p["first_"], p["last_"]
                yield data[a : hi + LENGTH], bytes(p["context_"]), data[lo:a]


def _numbers(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for each place; places that share one by chance are only sorted besides."""
    return (keys.astype(np.int64).view(np.uint64) + at.astype(np.uint64) * np.uint64(_BASE)).view(np.int64)


def _listed(chosen: Broadcast):
    """Of every document that has chosen places its bytes and these places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, numbers = chosen.value
        for batch in batches:
            batch, lists = batch[within(keys, batch["key_"].to_numpy())], []
            for key, data in zip(batch["key_"], batch["data_"]):
                data, found = bytes(data), anchors(bytes(data))
                hit = within(numbers, _numbers(np.array([key]), found[0]))
                lists.append([{"at_": a, "first_": lo, "last_": hi, "context_": _context(data, a, lo, hi)} for a, lo, hi in zip(*(x[hit].tolist() for x in found))])
            yield pd.DataFrame({"data_": batch["data_"].tolist(), "places_": lists})

    return run


def range_bounds(picked: list[tuple[bytes, bytes]], ranges: int) -> list[tuple[bytes, bytes]]:
    """Where ranges end, from a sorted sample of suffixes with the hashes of their contexts."""
    return sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)}) if picked else []


def _runs(bounds: list[tuple[bytes, bytes]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            held.sort()
            parts: dict[int, list] = {}
            for item in held:
                parts.setdefault(bisect_right(bounds, item[:2]), []).append(item)
            blobs = []
            for part, items in parts.items():
                lcps, rests = front_coded([i[0] for i in items])
                blobs.append((part, zlib.compress(pickle.dumps((lcps, rests, [i[1:] for i in items])), 1)))
            return pd.DataFrame(blobs, columns=["range_", "run_"])

        for item in _items(batches):
            held.append(item)
            size += len(item[0]) + len(item[2])
            if size > RUN_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge one range; per context the distances to its anchor of strings that repeat.

    Rows with a hash (``string_``) are of strings that may stand in other ranges, too, one for each.
    """
    runs = [decoded(*pickle.loads(zlib.decompress(bytes(r)))) for frame in frames for r in frame["run_"]]
    out: list[tuple] = []
    repeated: dict[bytes, list[int]] = {}
    #: By distance to the anchor: strings of the contexts that share the bytes from the anchor on, and who has them.
    met: dict[int, dict[bytes, list[bytes]]] = {}
    held, reach = 0, LENGTH  # contexts so far agree with the first one up to there; beyond the ends of a range anything can agree

    def pieces(least: int) -> Iterator[pd.DataFrame]:
        if len(repeated) >= least:
            out.extend((None, context, found) for context, found in repeated.items())
            repeated.clear()
        if len(out) >= least:
            for at in range(0, len(out), PIECE):
                yield pd.DataFrame(out[at : at + PIECE], columns=["string_", "context_", "os_"])
            out.clear()

    def close(agree: int) -> Iterator[pd.DataFrame]:
        """Decide the strings that reach further than what the next context shares."""
        nonlocal held
        for o in [o for o in met if LENGTH - o > agree]:
            for string, contexts in met.pop(o).items():
                held -= 1
                if len(contexts) > 1:
                    for context in contexts:
                        repeated.setdefault(context, []).append(o)
                if agree < 0 or LENGTH - o <= reach:
                    out.append((string, contexts[0], [o]))
            yield from pieces(PIECE)

    def settle(item, agree: int) -> None:
        nonlocal held
        suffix, (context, left) = item
        # A string with o bytes before the anchor has LENGTH - o from it on.
        for o in range(max(LENGTH - len(suffix), LENGTH - agree, 0), len(left) + 1):
            strings = met.setdefault(o, {})
            string = xxhash.xxh3_128_digest(left[len(left) - o :] + suffix[: LENGTH - o], seed=o)
            held += string not in strings
            strings.setdefault(string, []).append(context)

    before, agreed = None, LENGTH
    for suffix, lcp, extra in merged(runs):
        if before is not None:
            settle(before, max(agreed, lcp))
            yield from close(lcp)
            agreed, reach = lcp, min(reach, lcp)
            if held > HELD:  # as if a range ended here
                yield from close(-1)
                reach = LENGTH
        before = (suffix, extra)
    if before is not None:
        settle(before, LENGTH)
        yield from close(-1)
    yield from pieces(0)


def repeated_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key_``, ``spans_``: maximal byte runs (first, stop) covered by repeated strings, per document that has any."""
    texts = _texts(docs, id_col, text_col)
    long = texts.filter(f"length(data_) >= {LENGTH}")
    # Repeated rows make some heads too many here; their places are told apart by key and place below.
    heads = long.select("data_").mapInPandas(_heads, "head_ long").groupBy("head_").agg(F.count("*").alias("n_"))
    often = small(heads.filter("n_ > 1").select("head_"), "heads")
    listed = as_array(often, "head_")
    places = long.mapInPandas(_places(listed), PLACES)
    live = small((places.join(often, "head_") if listed is None else places).drop("head_"), "places")
    release(often)
    one = F.struct("key_", "at_", "first_", "last_")
    contexts = live.groupBy("context_").agg(F.min(one).alias("one_"), F.max(one).alias("two_"))
    contexts = small(contexts.select("context_", "one_.*", (F.col("one_") != F.col("two_")).alias("twice_")), "contexts")

    distinct, lists_ = texts.dropDuplicates(["key_"]), []

    def with_data(some: DataFrame) -> DataFrame:
        """The documents of the places, with them; texts are shuffled only when the places are too many to send."""
        lists_.append(lists := small(some.groupBy("key_").agg(F.collect_list(F.struct("at_", "first_", "last_", "context_")).alias("places_")), "lists"))
        return (texts.join(F.broadcast(lists), "key_") if some.count() <= LISTED // 4 else distinct.join(lists, "key_"))

    count = contexts.count()
    ranges = max(1, -(-count // RANGE))
    step = max(1, count // max(SAMPLE, PER_RANGE * ranges))
    sample = with_data(contexts.filter(F.abs(F.xxhash64("context_")) % step == 0))
    picked = sorted((bytes(s), bytes(c)) for s, c in sample.mapInPandas(
        lambda bs: (pd.DataFrame([i[:2] for i in _items([b])], columns=["s", "c"]) for b in bs), "s binary, c binary").collect())
    into_runs, chosen = _runs(range_bounds(picked, ranges)), None
    if count <= LISTED:
        at = contexts.select("key_", "at_").toArrow()
        keys = at["key_"].to_numpy()
        chosen = docs.sparkSession.sparkContext.broadcast((np.unique(keys), np.sort(_numbers(keys, at["at_"].to_numpy()))))
        find = _listed(chosen)
        runs = long.mapInPandas(lambda batches: into_runs(find(batches)), "range_ int, run_ binary")
    else:
        runs = with_data(contexts).mapInPandas(into_runs, "range_ int, run_ binary")
    # A repeated row may send its contexts twice; those that no other row has then count as repeated, and the row goes whole below.
    strings = small(runs.groupBy("range_").applyInPandas(_strings, "string_ binary, context_ binary, os_ array<int>"), "strings")
    release(*lists_)
    again = strings.filter("string_ is not null").groupBy("string_").agg(F.count("*").alias("n_")).filter("n_ > 1").select("string_")
    offsets = strings.filter("string_ is null").drop("string_").unionByName(strings.join(again, "string_").drop("string_"))
    offsets = offsets.groupBy("context_").agg(F.array_distinct(F.flatten(F.collect_list("os_"))).alias("os_"))
    verdict = contexts.select("context_", "twice_").join(offsets, "context_", "left").filter("twice_ or os_ is not null")
    found = live.join(verdict, "context_").select("key_", F.explode(F.expr(
        "if(twice_, array(struct(first_ as first, last_ as last)),"
        " filter(transform(os_, o -> struct(at_ - o as first, at_ - o as last)), s -> s.first between first_ and last_))")).alias("s_"))
    place = "array<struct<first:bigint,stop:bigint>>"
    spans = F.expr(f"""aggregate(runs_, cast(array() as {place}), (a, s) -> if(size(a) > 0 and s.first <= element_at(a, -1).stop,
        array_append(slice(a, 1, size(a) - 1), struct(element_at(a, -1).first as first, greatest(element_at(a, -1).stop, s.last + {LENGTH}) as stop)),
        array_append(a, struct(s.first as first, s.last + {LENGTH} as stop))))""")
    found = found.groupBy("key_").agg(F.sort_array(F.collect_set("s_")).alias("runs_"))
    # A row that is there twice is covered whole by strings of the other one.
    twice = small(long.groupBy("key_").agg(F.count("*").alias("n_"), F.first(F.length("data_")).alias("stop_")).filter("n_ > 1"), "twice")
    whole = twice.select("key_", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("stop_").cast("long").alias("stop"))).alias("spans_"))
    found = found.select("key_", spans.alias("spans_")).join(twice.select("key_"), "key_", "left_anti")
    found = small(found.unionByName(whole), "spans")
    release(live, contexts, strings, twice)
    return found


def drop_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``kept`` (remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
    kind = docs.schema[id_col].dataType.simpleString()
    spans = repeated_spans(docs, id_col, text_col)
    total = spans.agg(F.coalesce(F.sum(F.size("spans_")), F.lit(0))).first()[0]
    rows = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("data_"),
                       row_key(id_col, text_col).alias("key_"))
    rows = rows.join(F.broadcast(spans) if total <= LISTED else spans, "key_", "left").select("id", "data_", "spans_")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, data, found in zip(batch["id"].astype(object), batch["data_"], batch["spans_"]):
                data, gone, at, parts = bytes(data), found if found is not None else [], 0, []
                for span in gone:
                    parts.append(data[at : span["first"]])
                    at = span["stop"]
                kept = b"".join([*parts, data[at:]])
                out.append((None if pd.isna(doc) else doc, kept, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInPandas(run, f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)
