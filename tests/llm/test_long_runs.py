"""Packing of texts with very long runs: no text ends the job, and the ids are the tokenizer's."""
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from offerboard.llm import packing
from offerboard.llm.common import settle

ODD = "\t\n\r\x0b\x0c \x85\xa0 　"


@pytest.fixture(scope="module")
def enc():
    return packing.encoder()


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("text", [
    "x" + " " * 400_000 + "y", "x" + " " * 20_000, " " * 20_000 + "y z", "a\n" + "\n" * 30_000 + "b", "\n" * 30_000 + " c", "\t" * 12_000 + "\n",
    "a" * 200_000, " " * 9_999 + "x" + " " * 10_000 + "'s", "x" + ODD * 3_000 + "y" + ODD * 2_000,
    "p<|endoftext|>" + " " * 15_000 + "<|endoftext|>" + "\n" * 15_000 + "q", " " * 10_001 + "\x1c" + "\x1f" * 20_000 + "7"])
def test_ids_equal_the_tokenizer(text, enc, tok):
    assert packing.token_ids(text, enc).tolist() == tok.encode(text, add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("text", ["x" + " " * 1_000_000 + "y", "x" + " " * 10_000_000 + "y", "\n" * 1_000_000 + "y", "\n" * 10_000_000,
                                  "a" * 1_000_000, "ab" * 5_000_000])
def test_ids_of_millions_decode_to_the_text(text, enc):
    ids = packing.token_ids(text, enc)
    assert ids[-1] == 0 and enc.decode(ids[:-1].tolist()) == text


def test_packing_such_texts(spark, enc):
    s = settle(spark)
    texts = ["x" + " " * 1_000_000 + "y", "\n" * 1_000_000, "short", None]
    rows = packing.pack(s.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, t in enumerate(texts):
        ids = packing.token_ids(t or "", enc)
        mine = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == i)
        assert sum(n for _, n, _, _ in mine) == len(ids) and {d for *_, d in mine} == {len(ids)}
        assert all(zlib.crc32(np.asarray(ids[a:a + n], "<u4").tobytes()) == c for a, n, c, _ in mine)
