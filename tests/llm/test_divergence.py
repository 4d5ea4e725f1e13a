"""Divergence audit against plain Python, with blocks of a few postings, and against SQL on the documents."""
import re
from collections import Counter, defaultdict

import pytest

from offerboard.llm import divergence
from offerboard.llm.common import settle, table
from offerboard.llm.queries import DIVERGENCE_SQL

SCHEMA = "doc_id long, text string, lang string, source string, term string, count int"


def brute(rows):
    terms = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {i: i + 32 for i in range(65, 91)}
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = terms.findall((text or "").translate(lower))
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        v = len(kept)
        total = {x: sum(count[lang, x][t] for t in kept) for x in sources}
        p = {x: {t: 1 + 10 ** 9 * (count[lang, x][t] + 1) // (total[x] + v) for t in kept} for x in sources}
        n = sum(total.values())
        q = {t: 1 + 10 ** 9 * (sum(count[lang, x][t] for x in sources) + 1) // (n + v) for t in kept}
        gap = lambda a, b: (a - b) ** 2 // b
        for x in sources:
            pairs = [(-sum(gap(p[x][t], p[y][t]) for t in kept), y.encode(), y) for y in sources if y != x]
            items = [(-gap(p[x][t], q[t]), t.encode(), t) for t in kept if count[lang, x][t] and p[x][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(items)[:200])):
                out |= {(lang, x, part, item, -value, i) for i, (value, _, item) in enumerate(ranked, 1)}
    return out


@pytest.fixture(scope="module")
def s(spark):
    return settle(spark)


def result(s, rows, **more):
    df = s.createDataFrame([(i, *r, "clash", 1) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    got = [tuple(r) for r in divergence.divergence(df, **more).collect()]
    assert len(got) == len(set(got))
    return set(got)


ROWS = ([("the Cat sat", "en", "a"), ("the cat, the dog", "en", "b"), ("THE cat1dog", "en", "c"), (None, "en", "d"), ("", "en", None),
         ("été ÉTÉ Ünï x", "fr", "a"), ("été été", "fr", "b"), ("un été ünï", "fr", "a"), ("rare", "xx", "only"), (None, None, None),
         ("\x00nul\x7fdel [x]", "en", "a")]
        + [("same words here", "en", "hot")] * 40
        + [(" ".join(f"w{chr(97 + (i * j) % 23)}" for j in range(i % 17)), "en", f"s{i % 5}") for i in range(120)])


@pytest.mark.parametrize("block", [5, 400_000])
def test_against_plain_python(s, block):
    assert result(s, ROWS, block=block) == brute(ROWS)


def test_runs_merge_in_several_passes(s, monkeypatch):
    monkeypatch.setattr(divergence, "FAN_IN", 2)
    monkeypatch.setattr(divergence, "SHARD_POSTINGS", 20)
    monkeypatch.setattr(divergence, "BATCH", 3)
    assert result(s, ROWS, block=9) == brute(ROWS)


def test_corrections_in_pieces(s, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 7)
    assert result(s, ROWS) == brute(ROWS)


def test_more_terms_than_a_group_lists(s):
    rows = [(" ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(0, 400, 1 + i % 3)), "en", f"s{i % 3}") for i in range(12)]
    got = result(s, rows)
    assert got == brute(rows) and max(r[5] for r in got if r[2] == "term") == 200


def test_edges(s):
    assert result(s, [("a", "en", "x")]) == set()
    assert result(s, [("a", "en", "x"), ("b", "en", "y")]) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
    assert divergence.divergence(s.createDataFrame([], SCHEMA)).count() == 0
    long = [("word " * 300_000, "en", "x")] + [("word other", "en", "y")] * 3
    assert result(s, long) == brute(long)


def test_against_sql(s):
    import duckdb
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    names = ["lang", "source", "part", "item", "value", "rank"]
    want = {tuple(r) for r in con.sql(f"SELECT {', '.join(names)} FROM ({DIVERGENCE_SQL}) x").fetchall()}
    got = {tuple(r) for r in divergence.divergence(table(s, folder, "documents")).select(names).collect()}
    assert got == want
