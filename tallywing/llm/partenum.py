"""Exact similarity join of shingle sets by partitioned signatures.

Two sets link when ``100 * |intersection| >= 80 * |union|``. Then they differ in at most
``k = (m + 5m // 4) // 9`` elements, m being the size of either. The hash space is cut into as many
partitions as the size band of a set asks; each partition's content is one signature. At most ``k``
partitions of a set can differ from a linked set's, so of its non-empty ones, put in an order that
depends on their content alone (most elements first), the first ``k + 1`` hold one that both sets emit.
A set near the upper end of its band emits for the next band, too; a set with no more than ``k``
non-empty partitions emits its first ``k + 1`` single elements besides, for others of this kind.
This is where the method departs from PartEnum as published, which enumerates subsets of partitions: subsets
here have one partition, in prefix order, and the second round's have one element (a prefix filter).

Sets that share a signature with another set are candidates, and these sign again with partitions so fine
that each holds one element, now ordered by how many candidates have it, rarest first. At most a fifth of
a set can be missing from a linked one, so the rarest fifth and one more are enough: what very many sets
share (a passage, a licence line) drops out without losing a pair, and most sets turn out to have no
partner. Sizes are dealt to steps of a quarter, and only sets of the same or the next step meet. Links are found without all pairs of a group: in each round every
group compares its members to one hub (the member that shares most with others), hubs leave the group,
and groups whose members are already connected are done. Rounds go on while each at least halves the pairs
left; then, or when no more than ``PAIRS_PER_ROW`` pairs are left for each row of the groups, the pairs
that can link by their sizes and are not yet connected are compared, each once, and the join is complete.

Equal sets are one set from the start. Sets, shingles and signatures are known by 64-bit hashes;
every candidate pair is compared by its whole sets.

Defined results: null or wordless text has no shingles, links with nothing and is its own component; a
text of fewer words than a shingle has one, all its words; rows with a null id take part and get
the component of the others (null where none has an id); repeated rows are equal sets; extra columns
are not carried by ``link_components`` and all are kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import as_array, bounded, release, row_key, short_batches, small, within
from tallywing.llm.graph import components

WORDS = 5
#: Similarity as a fraction of whole numbers.
NEED, OF = 80, 100
#: Size bands: upper sizes grow by this factor; partitions per element at the upper end.
BAND, PER_ELEMENT = 3, 0.32
PAIRS_PER_ROW = 4
#: Least signatures of a set that its rows carry in the last round.
FIRSTS = 32
COMPARED = "a long, b long, linked boolean, common long, size_a long, misses array<long>, besides array<long>"
#: Words and, when texts are compared, elements of sets whose hashes a task remembers.
KNOWN_WORDS, KNOWN_ELEMENTS = 200_000, 2_000_000
#: Rows up to which a list of documents is broadcast.
LISTED = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[1]
    x = (x ^ (x >> np.uint64(29))) * _ODD[0]
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sorted distinct shingle hashes of texts; remembers the hashes of words it met lately."""

    def __init__(self, size: int = WORDS):
        self.size, self.words = size, {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        if len(words) < self.size:
            return np.array([xxhash.xxh64_intdigest(b"\n".join(words))], dtype=np.uint64)
        known = self.words
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = len(h) - self.size + 1
        total = np.zeros(n, dtype=np.uint64)
        for k in range(self.size):
            total = total * _MIX + _mixed(h[k : k + n] + _ODD[k % len(_ODD)])
        return np.unique(_mixed(total))


class Sets:
    """Sets of texts by name; remembers those met lately, as far as their elements are no more than ``KNOWN_ELEMENTS``."""

    def __init__(self):
        self.shingles, self.sets, self.held = Shingles(), {}, 0

    def of(self, name: int, text: str) -> np.ndarray:
        if name in self.sets:
            return self.sets[name]
        s = self.shingles.of(text)
        if self.held + len(s) > KNOWN_ELEMENTS:
            self.sets.clear()
            self.held = 0
        self.sets[name] = s
        self.held += len(s)
        return s


def bound(m: int) -> int:
    """Most elements by which a set of ``m`` can differ from a linked one."""
    return (m + m * OF // NEED) * (OF - NEED) // (OF + NEED)


def band(m: int) -> int:
    b, top = 0, 3
    while m > top:
        b, top = b + 1, top * BAND
    return b


def partitions(b: int) -> int:
    """Small sets get more partitions for each element, so that few of these stay empty by chance."""
    return max(1, int(3 * BAND**b * (PER_ELEMENT if b > 3 else 0.7))) if b else 1


def families(s: np.ndarray) -> list[np.ndarray]:
    """Per band in which a set of sorted hashes meets others: the first ``k + 1`` contents of its partitions.

    Contents come in an order that depends on them alone, most elements first.
    """
    m, k, out, odd = len(s), bound(len(s)), [], False
    for b in sorted({band(m), band(m * OF // NEED)}):
        n = partitions(b)
        part = ((s >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        count = np.diff(np.r_[first, m])
        content = np.add.reduceat(_mixed(s), first)
        sig = _mixed(content + (part[first] * _ODD[2]) + np.uint64((b + 1) * int(_ODD[3]) % 2**64))
        odd |= len(first) <= k
        out.append(sig[np.lexsort((sig, -count))][: k + 1])
    if odd:
        out.append(np.sort(_mixed(s + _ODD[4]))[: k + 1])
    return out


def signatures(s: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate(families(s))) if len(s) else np.empty(0, dtype=np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def set_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key_``, ``id_``, ``n_``, ``set_`` (hash of the set; null when empty), ``sigs_``, one row per document."""
    rows = docs.select(row_key(id_col, text_col).alias("key_"), F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for batch in batches:
            sets = [shingles.of(t if isinstance(t, str) else None) for t in batch["text_"]]
            yield pd.DataFrame({
                "key_": batch["key_"], "id_": batch["id_"], "n_": [len(s) for s in sets],
                "set_": pd.array([_set_id(s) for s in sets], dtype="Int64"),
                "sigs_": [_signed(signatures(s)) for s in sets],
            })

    return rows.mapInPandas(run, f"key_ long, id_ {kind}, n_ long, set_ long, sigs_ array<long>")


def _set_id(s: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def _shared_signatures(sets: DataFrame) -> DataFrame:
    """(``set_``, ``sig_``): signatures that more than one row has.

    Their list is sent to the tasks as one sorted array while that is small, else joined.
    """
    rows = sets.select("set_", F.explode("sigs_").alias("sig_"))
    often = small(rows.groupBy("sig_").agg(F.count("*").alias("n_")).filter("n_ > 1").select("sig_"), "often")
    listed = as_array(often, "sig_")
    if listed is None:
        members = small(rows.join(often, "sig_").distinct(), "members")
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sigs, ends = batch.column("sigs_").values.to_numpy(), batch.column("sigs_").offsets.to_numpy()
                names = np.repeat(batch.column("set_").to_numpy(), np.diff(ends))
                sigs = sigs[ends[0] : ends[-1]]
                hit = within(listed.value, sigs)
                yield pa.RecordBatch.from_arrays([pa.array(names[hit]), pa.array(sigs[hit])], names=["set_", "sig_"])

        found = sets.filter("set_ is not null").select("set_", "sigs_").mapInArrow(run, "set_ long, sig_ long")
        members = small(found.distinct(), "members")
        listed.unpersist()
    release(often)
    return members


def candidates(sets: DataFrame) -> DataFrame:
    """``set_``: sets that share a signature with a different set."""
    members = _shared_signatures(sets)
    ends = members.groupBy("sig_").agg(F.min("set_").alias("lo_"), F.max("set_").alias("hi_")).filter("lo_ < hi_")
    found = small(members.join(ends.select("sig_"), "sig_").select("set_").distinct(), "candidates")
    release(members)
    return found


def refined(texts: DataFrame) -> DataFrame:
    """Of every candidate its rarest elements, where others share them, per size step: ``sig_``, ``set_``.

    With them the set's size ``m_``, the number ``v_`` of its elements that other candidates have, and ``own_``, whether
    the step is the set's own one or the next.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for batch in batches:
            sets = [shingles.of(t) for t in batch["text_"]]
            yield pd.DataFrame({"set_": batch["set_"], "m_": [len(s) for s in sets], "sigs_": [_signed(s) for s in sets]})

    signed = small(texts.select("set_", "text_").mapInPandas(run, "set_ long, m_ long, sigs_ array<long>"), "fine")
    rows = signed.select("set_", "m_", F.explode("sigs_").alias("sig_"))
    often = small(rows.groupBy("sig_").agg(F.count("*").alias("times_")).filter("times_ > 1"), "often")
    shared = rows.join(bounded(often, LISTED), "sig_").groupBy("set_", "m_").agg(
        F.sort_array(F.collect_list(F.struct("times_", "sig_"))).alias("shared_"))
    # Elements that no other candidate has come first; what is left of the prefix is taken from the others.
    need = f"m_ - cast(ceil(m_ * {NEED} / {OF}) as int) + 1"
    rare = F.expr(f"slice(shared_, 1, cast(greatest(0, {need} - (m_ - size(shared_))) as int))")
    step = f"cast(floor(ln(m_) / ln({OF / NEED})) as int)"
    out = shared.select("set_", "m_", F.size("shared_").alias("v_"), F.explode(rare).alias("s_"), F.expr(step).alias("step_"))
    out = out.select("set_", "m_", "v_", "s_", F.col("step_").alias("own_"), F.explode(F.expr("array(step_, step_ + 1)")).alias("step_"))
    members = small(out.select(F.xxhash64("s_.sig_", "step_").alias("sig_"), "set_", "m_", "v_", (F.col("own_") == F.col("step_")).alias("own_")), "members")
    release(signed, often)
    return members


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the groups that hold more than one component, with their label and ``size_`` of the group."""
    labelled = members.select("sig_", "set_", "m_", "v_", "own_").join(labels.distinct(), "set_", "left")
    labelled = labelled.withColumn("label_", F.coalesce("label_", "set_"))
    ends = labelled.groupBy("sig_").agg(F.min("label_").alias("lo_"), F.max("label_").alias("hi_"), F.count("*").alias("size_"))
    return small(labelled.join(ends.filter("lo_ < hi_").select("sig_", "size_"), "sig_"), "open")


def _fit(a: str, b: str) -> str:
    """SQL: the common elements can be enough for a link; there are no more than either shares with anyone."""
    return f"{OF + NEED} * least(v_{a}, v_{b}) >= {NEED} * (m_{a} + m_{b})"


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) compared by their texts: ``linked``, the number of ``common`` elements, the size of ``a``.

    When half of ``a`` is common, also which elements of it ``b`` misses and which it has besides.
    """
    left = pairs.join(texts.select(F.col("set_").alias("a"), F.col("text_").alias("text_a")), "a")
    both = left.join(texts.select(F.col("set_").alias("b"), F.col("text_").alias("text_b")), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = Sets().of
        for batch in batches:
            out = []
            for a, b, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
                x, y = of(a, text_a), of(b, text_b)
                at = np.searchsorted(x, y)
                hit = x[np.minimum(at, len(x) - 1)] == y
                common = int(hit.sum())
                close = 2 * common >= len(x)
                out.append((a, b, OF * common >= NEED * (len(x) + len(y) - common), common, len(x),
                            _signed(np.delete(x, at[hit])) if close else None, _signed(y[~hit]) if close else None))
            yield pd.DataFrame(out, columns=["a", "b", "linked", "common", "size_a", "misses", "besides"])

    return small(both.select("a", "b", "text_a", "text_b").mapInPandas(run, COMPARED), "compared")


def _linked_by_hub(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """Of pairs compared to the same hub, those that link, from what each misses of the hub and has besides."""
    left, right = (near.withColumnsRenamed({c: f"{c}_{x}" for c in near.columns}) for x in "ab")
    both = pairs.join(left, F.col("a") == F.col("set__a")).join(right, F.col("b") == F.col("set__b"))
    common = F.expr("size_a_a - size(array_union(misses_a, misses_b)) + size(array_intersect(besides_a, besides_b))")
    sizes = F.expr("common_a + size(besides_a) + common_b + size(besides_b)")
    return both.withColumn("both_", common).filter(OF * F.col("both_") >= NEED * (sizes - F.col("both_"))).select("a", "b")


def set_components(docs: DataFrame, text_col: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents (``key_``, ``id_``, ``n_``, ``set_``), and ``set_``, ``label_`` for sets that link with another one."""
    spark = docs.sparkSession
    short_batches(spark)
    signed = small(set_table(docs, id_col, text_col), "signed")
    found = candidates(signed)
    sets = small(signed.select("key_", "id_", "n_", "set_"), "sets")
    release(signed)
    wanted = sets.select("set_", "key_").join(bounded(found, LISTED), "set_")
    wanted = small(wanted.groupBy("set_").agg(F.min("key_").alias("key_")), "wanted")
    rows = docs.select(row_key(id_col, text_col).alias("key_"), F.col(text_col).alias("text_"))
    texts = small(rows.join(bounded(wanted, LISTED), "key_").dropDuplicates(["set_"]).select("set_", "text_"), "texts")
    members = refined(texts)
    live = _open(members, members.select("set_", F.col("set_").alias("label_")))
    release(members)
    compared = spark.createDataFrame([], COMPARED)
    labels = spark.createDataFrame([], "set_ long, label_ long")
    before = math.inf
    while True:
        sizes = live.groupBy("sig_", "label_").agg(F.count("*").alias("n_")).groupBy("sig_").agg(
            F.sum("n_").alias("n_"), F.sum(F.col("n_") * F.col("n_")).alias("same_"))
        rows_left, pairs_left = sizes.agg(
            F.coalesce(F.sum("n_"), F.lit(0)), F.coalesce(F.sum((F.col("n_") * F.col("n_") - F.col("same_")) / 2), F.lit(0))).first()
        if not rows_left:
            return sets, labels
        last = before < math.inf and (pairs_left <= PAIRS_PER_ROW * rows_left or 2 * pairs_left > before)
        before = pairs_left
        if last:
            near = compared.filter("misses is not null").groupBy("b").agg(
                F.max_by(F.struct("a", "common", "size_a", "misses", "besides"), F.struct("common", "a")).alias("h_"))
            near = small(near.select(F.col("b").alias("set_"), F.col("h_.a").alias("hub_"), "h_.common", "h_.size_a", "h_.misses", "h_.besides"), "near")
            firsts = live.groupBy("set_", "own_").agg(F.slice(F.array_sort(F.collect_set("sig_")), 1, FIRSTS).alias("firsts_"))
            profile = firsts.join(near.select("set_", "hub_", F.col("common").alias("c_")), "set_", "left")
            live = live.join(profile, ["set_", "own_"], "left")
            other = live.select("sig_", F.col("set_").alias("b"), *(F.col(f"{c}_").alias(f"{c}_b") for c in ("label", "m", "v", "hub", "c", "firsts", "own")))
            # Sets of one step meet at that step alone, and a pair that shares several signatures meets at the least it is known to share.
            once = "(own_ or own_b) and not arrays_overlap(filter(firsts_, s -> s < sig_), firsts_b)"
            met = live.withColumnRenamed("set_", "a").join(other, "sig_").filter(f"a < b and label_ != label_b and {_fit('', 'b')} and {once}")
            met = met.withColumn("same_", F.expr("coalesce(hub_ = hub_b, false)")).filter(
                f"not same_ or {OF + NEED} * least(c_, c_b) >= {NEED} * (m_ + m_b)").select("a", "b", "same_")
            # Two sets whose part in their hub is not enough must share an element outside it.
            outside = live.select("set_", "label_", "m_", "v_").distinct().join(near.select("set_", "hub_", "besides"), "set_")
            outside = outside.select("set_", "label_", "m_", "v_", "hub_", F.explode("besides").alias("sig_"))
            other = outside.select("hub_", "sig_", F.col("set_").alias("b"), *(F.col(f"{c}_").alias(f"{c}_b") for c in ("label", "m", "v")))
            more = outside.withColumnRenamed("set_", "a").join(other, ["hub_", "sig_"]).filter("a < b and label_ != label_b and " + _fit("", "b"))
            pairs = small(met.unionAll(more.select("a", "b", F.lit(True).alias("same_"))).distinct(), "pairs")
            links = compared.filter("linked").select("a", "b").unionAll(_linked_by_hub(pairs.filter("same_").select("a", "b"), near))
            pairs = pairs.filter("not same_").select("a", "b")
        else:
            # The hub shares most elements with others.
            hubs = live.groupBy("sig_").agg(F.max(F.struct("v_", "m_", "set_", "label_")).alias("hub_"))
            hubs = small(hubs.select("sig_", F.col("hub_.set_").alias("hub_"), F.col("hub_.label_").alias("hub_label_"), F.col("hub_.m_").alias("m_b"), F.col("hub_.v_").alias("v_b")), "hubs")
            met = live.join(hubs, "sig_").filter("label_ != hub_label_ and " + _fit("", "b"))
            pairs = met.select(F.col("hub_").alias("a"), F.col("set_").alias("b")).distinct()
            links = compared.filter("linked").select("a", "b")
        new = _compared(pairs, texts)
        compared, links = compared.unionAll(new), links.unionAll(new.filter("linked").select("a", "b"))
        labels = small(components(links).select(F.col("node").alias("set_"), F.col("label").alias("label_")), "labels")
        if last:
            return sets, labels
        left = live.join(hubs.select("sig_", F.col("hub_").alias("set_")), ["sig_", "set_"], "left_anti")
        spent, live = live, _open(left, labels)
        release(spent, hubs)


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the least id reachable over links."""
    return _with_component(*set_components(docs, text_col, id_col)).select(
        F.col("id_").alias(id_col), F.col("n_").alias("n_shingles"), F.col("component_").alias("component_id"))


def _with_component(sets: DataFrame, labels: DataFrame) -> DataFrame:
    rows = sets.select("key_", "id_", "n_", "set_").join(labels, "set_", "left").withColumn("label_", F.coalesce("label_", "set_"))
    least = rows.filter("label_ is not null").groupBy("label_").agg(F.min("id_").alias("least_"))
    return rows.join(least, "label_", "left").withColumn("component_", F.coalesce("least_", "id_"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component: the one with the least id (null last), then the least key, then the least row.

    Rows without shingles are no copies of each other and all stay.
    """
    names = docs.columns
    sets, labels = set_components(docs, text_col, id_col)
    found = _with_component(sets, labels)
    found = found.filter("n_ > 0")
    first = found.groupBy("label_").agg(F.min(F.struct(F.col("id_").isNull().alias("null_"), "id_", "key_")).alias("kept_"))
    gone = found.join(first, "label_").filter("key_ != kept_.key_")
    gone = small(gone.select("key_").distinct(), "gone")
    rows = docs.select(F.struct(*(F.col(c) for c in names)).alias("row_"), row_key(id_col, text_col).alias("key_"))
    rows = rows.join(bounded(gone, LISTED), "key_", "left_anti")
    # Rows that repeat a key are equal sets and not told apart above; only these are shuffled, one for each task.
    twice = small(sets.filter("n_ > 0").groupBy("key_").agg(F.count("*").alias("times_")).filter("times_ > 1").select("key_"), "twice")
    if not twice.take(1):
        return rows.select("row_.*")
    twice = bounded(twice, LISTED)
    one = rows.join(twice, "key_", "left_semi").groupBy("key_").agg(F.min("row_").alias("row_"))
    return rows.join(twice, "key_", "left_anti").select("row_").unionAll(one.select("row_")).select("row_.*")
