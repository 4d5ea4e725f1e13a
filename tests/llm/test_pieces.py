"""Encoding and decoding by distinct chunks against the library on the whole text."""
import random

import pytest
from sentencepiece import SentencePieceProcessor

from offerboard.llm import pieces
from offerboard.llm.common import settle, table
from offerboard.llm.queries import op13_pieces

SCHEMA = "doc_id long, text string, ids string, decoded int"
rnd = random.Random(5)
TEXTS = [None, "", " ", "  ", "▁", "▁ ▁a  ▁", "a▁b", "  a b ", "\n", "x\ty\r\n z", "<s> </s> <unk> <0x0A>", "日本𝕏\0z é́ ﬁ Ａ", "​﻿",
         "x" + " " * 1_000_000 + "y", "\n" * 300_000, "ab c " * 400_000, "q" * 300_000, *("a b",) * 40]
TEXTS += ["".join(rnd.choice(" ▁a\ńé𝕏<0x>bcde") for _ in range(rnd.randint(0, 60))) for _ in range(800)]


@pytest.fixture(scope="module")
def s(spark):
    return settle(spark)


@pytest.fixture(scope="module")
def model():
    return SentencePieceProcessor(model_file=pieces.MODEL)


def both(df):
    return {r.doc_id: r for r in pieces.decode(pieces.encode(df)).collect()}


def check(got, texts, model):
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = model.encode(t or "")
        assert got[i].ids == ids and got[i].decoded == model.decode(ids), (i, (t or "")[:40])


@pytest.mark.parametrize("cut, kept", [(pieces.SLICE, pieces.TABLE), (7, 3)])
def test_against_the_library(s, model, monkeypatch, cut, kept):
    texts = TEXTS if cut > 7 else [t for t in TEXTS if len(t or "") < 1000]
    monkeypatch.setattr(pieces, "SLICE", cut)
    monkeypatch.setattr(pieces, "TABLE", kept)
    df = s.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    check(both(df), texts, model)


def test_models_whose_pieces_cross_markers_encode_whole_texts(model):
    t = pieces.ChunkTable()
    assert t.apart
    t.apart = False
    ids, counts = t.encode(["a b c", None])
    assert ids.tolist() == model.encode("a b c") and counts.tolist() == [len(ids), 0]


def test_decode_of_special_ids_stray_bytes_and_nulls(s, model):
    byte = lambda b: model.piece_to_id(f"<0x{b:02X}>")
    lists = [None, [], [0, 264], [1, 264, 2], [264, byte(0xE6)], [byte(0xF0), byte(0x9D), 264], [28705], [28705, 264, 28705]]
    df = s.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in pieces.decode(df).collect()}
    assert got == {i: model.decode(x or []) for i, x in enumerate(lists)}


def test_repeated_rows_null_ids_and_empty_tables(s):
    df = s.createDataFrame([(1, "a b", "", 0), (1, "a b", "", 0), (None, "c", "", 0)], SCHEMA)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in pieces.encode(df).collect()) == [(0, 1), (1, 2), (1, 2)]
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0


def test_query_digests(s, model):
    import hashlib
    folder = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: r for r in op13_pieces(s, folder).collect()}
    for r in table(s, folder, "documents").collect():
        ids = model.encode(r.text or "")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
