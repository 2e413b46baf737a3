"""Piece encoding and decoding against the library whose results they have to give."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from tallywing.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=" abcdeinorst\n\r\t.▁é", max_size=60)))
def test_text_as_the_library(model, library, text):
    ids = model.encode(text)
    assert ids.tolist() == library.encode(text)
    assert model.decode(ids) == library.decode(ids.tolist())


def test_joined_pieces_as_the_library(model, library):
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(model.names) for _ in range(rng.randint(0, 25))).replace("▁", " ")
        assert model.encode(text).tolist() == library.encode(text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 700, "\n" * 50, "ab" * 3000, "═" * 100 + "ab", "x" + " " * 17 + "y", "\x00a\x00"])
def test_long_runs_as_the_library(model, library, text):
    assert model.encode(text).tolist() == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 261), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_the_library(model, library, ids):
    assert model.decode(np.array(ids, dtype=np.int32)) == library.decode(ids)


def test_bounded_stores_give_the_same_ids(monkeypatch, library):
    monkeypatch.setattr(pieces, "SEGMENTS", 20)
    monkeypatch.setattr(pieces, "PAIRS", 10)
    small, rng = pieces.PieceModel(PATH), random.Random(4)
    for _ in range(200):
        text = " ".join("".join(rng.choice("aeinst") for _ in range(rng.randint(1, 9))) for _ in range(30))
        assert small.encode(text).tolist() == library.encode(text)
        assert len(small.recent) <= 20 and len(small.older) <= 20 and len(small.pairs) <= 10


def test_edges(edge, library):
    clash = edge.withColumn("ids", edge["kept"]).withColumn("decoded", edge["kept"])
    found = pieces.decode_ids(pieces.encode_texts(clash, PATH), PATH).collect()
    assert len(found) == edge.count()
    for row in found:
        assert list(row.ids) == library.encode(row.text or "")
        assert row.decoded == (row.text or "") and row.key_ == "x"
    assert pieces.decode_ids(pieces.encode_texts(edge.limit(0), PATH), PATH).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [264])], "k long, ids array<int>")
    assert sorted((r.k, r.decoded) for r in pieces.decode_ids(rows, PATH).collect()) == [(1, ""), (2, ""), (3, "a")]
