"""Marks of words: equal words meet, built and random different ones do not, and texts of such words are not linked."""
import numpy as np
import pyarrow as pa

from offerboard.llm import setjoin
from offerboard.llm.common import settle, utf8, word_hashes, word_marks


def thue_morse(n, a="a", b="b"):
    w = [a]
    while len(w) < n:
        w += [b if x == a else a for x in w]
    return "".join(w)


def marks(texts):
    m, at = word_marks(*utf8(pa.array(texts, pa.string())))
    return [m[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_structured_words_do_not_meet():
    one, two = thue_morse(4096), thue_morse(4096, "b", "a")
    h, _ = word_hashes(*utf8(pa.array([one, two])), lower=True)
    assert h[0] == h[1]                                # the sums of powers do meet
    (a,), (b,) = marks([one, two])
    assert a != b


def test_equal_words_meet_wherever_they_stand():
    got = marks(["  Ab cd\tab\n", "xx ab", None, "", " ", "é É aB", "ab"])
    assert [len(g) for g in got] == [3, 2, 0, 0, 0, 3, 1]
    assert {got[0][0], got[0][2], got[1][1], got[5][2], got[6][0]} == {got[6][0]} and got[5][0] != got[5][1]
    rng = np.random.default_rng(1)
    words = {"".join(chr(97 + c) for c in rng.integers(0, 3, rng.integers(1, 12))) for _ in range(20_000)}
    assert len({m for m, in marks(sorted(words))}) == len(words)


def test_documents_of_such_words_are_not_linked(spark):
    s = settle(spark)
    one, two = thue_morse(2048), thue_morse(2048, "b", "a")
    docs = s.createDataFrame([(1, one), (2, two), (3, one.upper()), (4, f"x y z {one} q"), (5, f"x y z {two} q")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in setjoin.link_documents(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
