"""Harmonic packing of tokenized documents into sequences of one capacity.

A document's ids are cut into lengths that are reciprocals of the capacity: with ``r`` ids left and
``j = ceil(capacity / r)``, the next piece has ``capacity // j`` ids. Pieces of class ``j`` fill bins of
exactly ``j`` pieces, whatever their documents, so each task packs on its own and keeps one open bin per
class: at most ``2 * SMALLEST`` bins, however many documents it reads. A tail of fewer than ``SMALLEST``
ids is not cut again and goes, in the same way, to the class of ``capacity // length`` pieces. What is
left in open bins at the end of a task is laid end to end, cut at the capacity, and the last ids are cut
into powers of two, which need no padding.

No shuffle takes place. A task that runs again gives the same pieces and the same ids of sequences, as
long as its input partition is read again in the same order, which a scan of files guarantees.

Defined results: null text is empty and has the end id alone; repeated rows are packed each; an empty
table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import short_batches

CAPACITY, END, SMALLEST = 4096, 2, 64
#: Words whose ids a Python worker remembers in a store, before it becomes the older of two.
GENERATION = 1_000_000
SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space and ignores case, one word at a time.

    Words are split at blanks, and closing punctuation after a letter is a token run of its own, so
    their ids can be remembered. Texts with a mark of a special token go to the tokenizer whole.
    """

    def __init__(self, path: str, remembered: int = GENERATION):
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """The word and its closing punctuation, which is split off only after a letter."""
        bare = word.rstrip(b".,;:!?")
        if len(bare) == len(word) or not bare or not bare.decode()[-1].isalpha():
            return word, b""
        return bare, word[len(bare):]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of new words; they and their parts are remembered."""
        parts = {w: self._parts(w) for w in words}
        known = {p: self.recent.get(p) or self.older.get(p) for pair in parts.values() for p in pair if p}
        new = sorted(p for p, ids in known.items() if ids is None)
        known.update(zip(new, self._encode([p.decode() for p in new])))
        known.update({w: known[bare] + known[end] for w, (bare, end) in parts.items() if end})
        self.recent.update(known)
        return known

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        if len(self.recent) > self.remembered:
            self.older, self.recent = self.recent, {}
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        marked = [b"<|" in r for r in raw]
        split = [[] if m else r.lower().split() for r, m in zip(raw, marked)]
        recent, older, missing, found = self.recent, self.older, set(), []
        for words in split:
            ids = list(map(recent.get, words))
            holes = [i for i, x in enumerate(ids) if x is None]
            for i in holes:
                x = older.get(words[i])
                if x is None:
                    missing.add(words[i])
                else:
                    recent[words[i]] = ids[i] = x
            found.append((ids, holes))
        known = self._learn(missing) if missing else {}
        out = []
        for text, mark, words, (ids, holes) in zip(texts, marked, split, found):
            if mark:
                out.append(self._encode([text])[0])
                continue
            for i in holes:
                if ids[i] is None:
                    ids[i] = known[words[i]]
            out.append(b"".join(ids))
        return out


def encoder(path: str, remembered: int = GENERATION) -> WordEncoder:
    """The encoder of this Python worker; what it remembers lasts over tasks and never changes ids."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = WordEncoder(path, remembered)
    return _ENCODERS[path, remembered]


class Packer:
    """Open bins of one task. Pieces are (document, start, ids, ids of the document)."""

    def __init__(self, base: int, capacity: int = CAPACITY, smallest: int = SMALLEST):
        self.base, self.capacity, self.smallest = base, capacity, smallest
        self.bins: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []
        self.count = 0

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.base + self.count, offset))
            offset += n
        self.count += 1

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while start < total:
            rest = total - start
            if rest < self.smallest:
                n, per_bin = rest, self.capacity // rest
                key = -rest
            else:
                per_bin = key = -(-self.capacity // rest)
                n = self.capacity // per_bin
            pieces = self.bins.setdefault(key, [])
            pieces.append((doc, start, ids[4 * start : 4 * (start + n)], total))
            if len(pieces) == per_bin:
                self.close(self.bins.pop(key))
            start += n

    def finish(self) -> None:
        left = [p for key in sorted(self.bins) for p in self.bins[key]]
        self.bins = {}
        rest = sum(len(p[2]) for p in left) // 4
        room, pieces = self._room(rest), []
        for doc, start, ids, total in left:
            while ids:
                part = ids[: 4 * room]
                pieces.append((doc, start, part, total))
                start, ids = start + len(part) // 4, ids[len(part):]
                room, rest = room - len(part) // 4, rest - len(part) // 4
                if not room:
                    self.close(pieces)
                    room, pieces = self._room(rest), []

    def _room(self, rest: int) -> int:
        """A full sequence, or the greatest power of two among the last ids."""
        return self.capacity if rest >= self.capacity else 1 << max(0, rest.bit_length() - 1)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", remembered: int = GENERATION) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``remembered`` words (about 200 bytes each) are kept in each of a worker's two stores; fewer take more time and less memory.
    """
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, remembered).texts
        packer = Packer(TaskContext.get().partitionId() << 36)
        end = np.array([END], dtype="<u4").tobytes()

        def taken() -> pd.DataFrame:
            rows, packer.rows = packer.rows, []
            frame = pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            return frame.astype({c: "int64" for c in frame.columns[1:]})

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                ids = [None if pd.isna(i) else i for i in part["id"].astype(object)]
                for doc, tokens in zip(ids, encode([t if isinstance(t, str) else None for t in part["text"]])):
                    packer.add(doc, tokens + end)
            if packer.rows:
                yield taken()
        packer.finish()
        if packer.rows:
            yield taken()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
