"""Encoding with a merge-ranked piece vocabulary, and decoding, without running any merge over a text.

Of a text's encoding by greedy merges, the last token of every prefix is unique. A prefix table holds it: an
automaton lists the pieces that end at a position, longest first, and the first that fits behind the last token
of the prefix before it is the position's token. Two tokens fit when greedy merging of their joint text gives these
two back; that is settled by replaying the merges inside each of them against the one merge across their border,
and remembered per pair. The ids are then read backwards from the end. The table is linear in the text's length.

No piece holds a blank after another character, and characters outside the vocabulary's alphabet merge with
nothing. Texts are therefore cut before blanks, and a worker remembers the ids of the segments it met, in two
stores of bounded size. Everything runs inside map tasks: no shuffle, nothing on the driver.

Defined results: null text is encoded as empty and has no ids; null ids decode to the empty text; every row is
encoded on its own, so repeated rows repeat their ids; an empty table gives no rows; other columns are carried,
whatever their names; unknown characters become byte pieces, or the unknown id where the vocabulary has none.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: Segments in a store before it becomes the older one, longest segment that is stored, and pairs that are remembered.
SEGMENTS, LONGEST, PAIRS = 300_000, 48, 1_000_000
#: Rows of an output batch.
ROWS = 512
_MODELS: dict[str, "PieceModel"] = {}


def _one_each(error: UnicodeError):
    return "�", error.start + 1


codecs.register_error("tallywing_one_each", _one_each)


class PieceModel:
    """Prefix tables of one vocabulary file. ``encode`` and ``decode`` take and give one text."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size, self.unknown = model.get_piece_size(), model.unk_id()
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.surface: list[bytes] = [b""] * self.size
        self.spaced = np.zeros(self.size, dtype=bool)
        self.shown = np.ones(self.size, dtype=bool)
        self.bytes: list[int | None] = [None] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_control(i):
                self.shown[i] = False
            elif model.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif model.is_byte(i):
                value = int(piece[3:5], 16)
                self.surface[i], self.bytes[value] = bytes([value]), i
            else:
                self.surface[i] = piece.replace(SPACE, " ").encode()
                self.spaced[i] = piece.startswith(SPACE)
                # Higher scores merge first; ranks grow as scores fall.
                self.rank[piece], self.ids[piece] = -model.get_score(i), i
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece holds a blank after another character")
        self.alphabet = {c for p in self.rank for c in p} | {SPACE}
        # Characters that occur in pieces without being one take part in merges under numbers of their own.
        self.names = [""] * self.size
        for piece, i in self.ids.items():
            self.names[i] = piece
        self.names += sorted(c for c in self.alphabet if c not in self.ids)
        self.merges: dict[int, tuple[str, str, list[tuple[float, str, str]]] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i, piece in enumerate(self.names):
            if piece and (i >= self.size or len(piece) == 1 or self._merged(i) is not None):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.lines = "\n" not in self.alphabet
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merged(self, token: int):
        """First and last character of a token and its merges in their order, each with the token's ends after it.

        None for a piece that greedy merging of its own text does not give: no encoding holds it.
        """
        if token in self.merges:
            return self.merges[token]
        parts, rank, steps = list(self.names[token]), self.rank, []
        first, last = parts[0], parts[-1]
        while len(parts) > 1:
            best, at = min((rank.get(parts[k] + parts[k + 1], np.inf), k) for k in range(len(parts) - 1))
            if best == np.inf:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        self.merges[token] = (first, last, steps) if len(parts) == 1 else None
        return self.merges[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether greedy merging of both texts together gives these two tokens."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is not None:
            return known
        (_, tail, ahead), (head, _, behind), rank = self._merged(left), self._merged(right), self.rank
        i = j = 0
        while True:
            across = rank.get(tail + head, np.inf)
            one = ahead[i][0] if i < len(ahead) else np.inf
            two = behind[j][0] if j < len(behind) else np.inf
            # Of merges of one rank the one further left comes first.
            if across < one and across <= two:
                result = False
                break
            if one == two == np.inf:
                result = True
                break
            if one <= two:
                tail, i = ahead[i][2], i + 1
            else:
                head, j = behind[j][1], j + 1
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = result
        return result

    def _table(self, text: str) -> list[int]:
        """Last token of every prefix of a text within the alphabet."""
        last, fits, pairs = [-1] * (len(text) + 1), self.fits, self.pairs
        for end, (token, length) in self.automaton.iter(text):
            if last[end + 1] < 0:
                before = last[end + 1 - length]
                # A position whose prefix ends inside no token cannot come up: every character is a token.
                if end + 1 == length or pairs.get(before << 32 | token) or fits(before, token):
                    last[end + 1] = token
        return last

    def segment(self, text: str) -> bytes:
        """Ids (native 32-bit) of a text that is cut from its surroundings by the rules above."""
        ids: list[int] = []
        start = 0
        while start < len(text):
            stop = start
            while stop < len(text) and text[stop] in self.alphabet:
                stop += 1
            if stop > start:
                part, found = text[start:stop], []
                last, at = self._table(part), stop - start
                while at:
                    found.append(last[at])
                    at -= len(self.names[last[at]])
                for token in reversed(found):
                    if token < self.size:
                        ids.append(token)
                    else:
                        ids += self._spelled(self.names[token])
            if stop < len(text):
                ids += self._spelled(text[stop])
                stop += 1
            start = stop
        return np.array(ids, dtype=np.int32).tobytes()

    def _spelled(self, char: str) -> list[int]:
        spelled = [self.bytes[b] for b in char.encode("utf-8", "replace")]
        return [self.unknown] if None in spelled else spelled

    def _known(self, part: str) -> bytes:
        """Ids of a part of :meth:`encode`, from the older store or by a prefix table."""
        ids = self.older.get(part)
        if ids is None:
            ids = self.segment(part if part[:1] == "\n" and self.lines else SPACE + part)
            if len(part) > LONGEST:
                return ids
        if len(self.recent) >= SEGMENTS:
            self.older, self.recent = self.recent, {}
        self.recent[part] = ids
        return ids

    def _spaced(self, parts: list[str]) -> list[bytes]:
        """Ids of parts some of which are empty: runs of blanks belong to the part behind them, unless a line ends there."""
        out, marks = [], 0
        for part in parts:
            ends = self.lines and part[:1] == "\n"
            marks += not ends
            if ends and marks:
                out.append(self.segment(SPACE * marks))
                marks = 0
            if ends or part:
                out.append(self.segment(SPACE * marks + part) if marks > 1 else self.recent.get(part) or self._known(part))
                marks = 0
        if marks:
            out.append(self.segment(SPACE * marks))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text. It is cut at blanks and before line feeds; a part's own leading mark is not written out."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        text = text.replace(SPACE, " ")
        parts = (text.replace("\n", " \n") if self.lines else text).split(" ")
        if "" in parts:
            out = self._spaced(parts)
        else:
            out = list(map(self.recent.get, parts))
            if None in out:
                out = [self._known(p) if ids is None else ids for p, ids in zip(parts, out)]
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the first blank goes, bytes that are no character become one mark each."""
        shown = self.shown[ids]
        if not shown.all():
            # Control ids have no text, but bytes on both sides of one make no character together.
            runs = np.split(ids, np.flatnonzero(~shown))
            first = self.spaced[ids[shown][:1]].any()
            text = "".join(self._joined(r) for r in runs)
            return text[1:] if first else text
        text = self._joined(ids)
        return text[1:] if len(ids) and self.spaced[ids[0]] else text

    def _joined(self, ids: np.ndarray) -> str:
        return b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "tallywing_one_each")


def piece_model(path: str) -> PieceModel:
    """The model of this Python worker; what it remembers lasts over tasks and never changes ids."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _with_column(df: DataFrame, source: str, name: str, kind: str, make) -> DataFrame:
    """``df`` with column ``name`` (in place of one of that name) of ``make``'s Arrow array for each part of ``source``."""
    kept = [c for c in df.columns if c.lower() != name.lower()]
    at = df.columns.index(source)
    positions = [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                arrays = [part.column(p) for p in positions] + [make(part.column(at))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, name])

    fields = [f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in kept]
    return df.mapInArrow(run, ", ".join([*fields, f"`{name}` {kind}"]))


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns and ``ids_col`` (array<int>): the text's ids without begin or end ids."""

    def make(texts: pa.Array) -> pa.Array:
        model = piece_model(model_path)
        found = [model.encode(t) for t in texts.to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))

    return _with_column(docs, text_col, ids_col, "array<int>", make)


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns and ``text_col``: the text that the ids stand for."""

    def make(lists: pa.Array) -> pa.Array:
        model = piece_model(model_path)
        flat = lists.values.to_numpy(zero_copy_only=False)
        ends, known = lists.offsets.to_numpy(), lists.is_valid().to_pylist()
        texts = [model.decode(flat[a:b]) if k else "" for a, b, k in zip(ends[:-1].tolist(), ends[1:].tolist(), known)]
        return pa.array(texts, type=pa.string())

    return _with_column(encoded, ids_col, text_col, "string", make)
