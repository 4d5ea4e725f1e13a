"""Hints and contexts of the personal data operator."""
import random
import re

import pytest
from pyspark.sql import functions as F

from offerboard.llm import pii
from offerboard.llm.common import settle


def drawn(kind, rng):
    """A string of the loose shape of a kind."""
    pick = rng.choice
    blank = lambda: pick(["", " "])
    word = lambda: "".join(pick("abcXYZ019-") for _ in range(rng.randint(1, 6)))
    digits = lambda a, b: "".join(pick("0123456789") for _ in range(rng.randint(a, b)))
    wrapped = lambda x: blank() + pick("[({") + blank() + x + blank() + pick("])}") + blank()
    if kind == "email":
        at = pick(["@", " at ", wrapped("at")])
        return word() + at + word() + "".join(pick([".", " dot ", wrapped("dot")]) + word() for _ in range(rng.randint(0, 3)))
    if kind == "ip":
        cut = lambda: pick([".", blank() + pick("[({") + pick([".", "dot"]) + pick("])}") + blank()])
        return digits(1, 3) + "".join(cut() + digits(1, 3) for _ in range(3))
    if kind == "card":
        return digits(1, 4) + "".join(pick([" ", "-"]) + digits(1, 4) for _ in range(rng.randint(2, 6)))
    return pick(["", "+", "("]) + digits(1, 3) + "".join(pick(" ()./0-9-123456789") for _ in range(rng.randint(5, 14))) + digits(1, 2)


@pytest.mark.parametrize("kind", pii.KINDS)
def test_hints_are_implied_by_the_shapes(spark, kind):
    rng = random.Random(5)
    texts = [drawn(kind, rng) for _ in range(2000)]
    texts = [t for t in texts if re.search(pii.LOOSE[kind], t)]
    assert len(texts) > 500
    d = spark.createDataFrame([(t,) for t in texts], "text string").withColumn(
        "match", F.regexp_extract("text", pii.LOOSE[kind], 0))
    missed = d.where(F.col("match") != "").where(pii.LOOSE_CHECK[kind](F.col("match"))).where(~F.col("text").rlike(pii.LOOSE_HINT[kind]))
    assert missed.collect() == []


def test_spaced_addresses_are_found(spark):
    settle(spark)
    talk = [*(f"the host at 10.0.0.{i} is up" for i in range(1, 9)), "the host at 10 [dot] 0 [dot] 0 [dot] 7 is up", "the host at 192 (dot) 168 (dot) 1 (dot) 20 is up"]
    d = spark.createDataFrame(list(enumerate(talk)), "doc_id long, text string")
    found = d.join(pii.find_pii(d), "doc_id").orderBy("doc_id").select(pii.redacted(F.col("text"), F.col("spans"))).collect()
    assert [r[0] for r in found] == ["the host at [IP] is up"] * 10


@pytest.mark.parametrize("text, want", [
    ("Contact: a@b.cc", []),
    ("Contact: a@b.cc now", ["contact _ now"]),
    ("Please mail a@b.cc now", ["please mail _", "mail _ now"]),
    ("mail a@b.cc or call", ["mail _ or", "_ or call"]),
    # words that the window cuts are left out
    ("y" * 54 + " mail a@b.cc or " + "z" * 50, ["y" * 54 + " mail _", "mail _ or"]),
    ("y" * 60 + " mail a@b.cc or " + "z" * 30, ["mail _ or", "_ or " + "z" * 30]),
])
def test_contexts_keep_whole_words(spark, text, want):
    d = spark.createDataFrame([(text,)], "text string")
    got = d.select(F.explode(pii.candidates(F.col("text"))).alias("c")).where("c.kind = 0").first()
    assert list(got.c.patterns) == want
