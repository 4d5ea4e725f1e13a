"""The mix stage moves each text once: copies, rows that differ in one column, nested columns and rows without an id."""
from collections import Counter

import pytest

from offerboard.llm import mixing
from offerboard.llm.common import settle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tags array<string>, more map<string,int>"


@pytest.fixture(scope="module")
def s(spark):
    return settle(spark)


def words(t):
    return (t or "").split()


def test_copies_and_look_alikes(s):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(1, text, "en", "a", 9, ["x"], {"k": 1})] * 5 + [(1, text, "de", "a", 9, ["x"], {"k": 1}), (1, text, "en", "a", 9, ["y"], {"k": 1}),
            (1, text, "en", "a", 9, ["x"], {"k": 2}), (None, text, "en", "b", 9, None, None), (None, None, None, None, None, None, None),
            (3, "", "en", "a", 0, [], {}), (4, "short one", None, None, 9, None, None)]
    docs = s.createDataFrame(rows, SCHEMA)
    mix = mixing.mix_sources(docs)
    got = mixing.mixed_documents(docs, mix, length_col="n_chars").collect()
    taken = Counter()
    for r in mix.documents.collect():
        taken[r.doc_id] += r.taken
    mixed = Counter()
    for r in got:
        mixed[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) and set(words(r.text)) <= set(words(text)) | {"short", "one"}
    assert mixed == +taken
    # every look-alike keeps its own columns
    seen = {(r.lang, tuple(r.tags or ()), tuple((r.more or {}).items())) for r in got if r.doc_id == 1}
    assert seen <= {("en", ("x",), (("k", 1),)), ("de", ("x",), (("k", 1),)), ("en", ("y",), (("k", 1),)), ("en", ("x",), (("k", 2),))}
    assert mixing.mixed_documents(docs.limit(0), mixing.mix_sources(docs.limit(0))).count() == 0


def test_one_exchange_a_text(s):
    docs = s.createDataFrame([(i, f"text number {i}", "en", "a", 1, None, None) for i in range(50)], SCHEMA)
    plan = mixing.mixed_documents(docs, mixing.mix_sources(docs))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "full#" in line]
    assert len(exchanges) <= 3, exchanges      # the texts once, the takes twice
    assert all("nth" not in line for line in exchanges)
