"""Training-data operators against plain Python, on small tables with nulls, empty texts, ties and repeated rows."""
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from offerboard.llm import language, mixing, neighbours, packing, pii, quality, setjoin, tokens, vectors
from offerboard.llm.common import settle, table
from offerboard.llm.htmltext import extract_text, main_text

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, kind int"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def s(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return settle(spark)


WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(f"{w}x{i % 977}" for i, w in enumerate(WORDS * 700))
TEXTS = ["", None, "  \n ", "a b c", "A b C", "one two three four five six seven", LONG,
         " ".join(WORDS), " ".join(WORDS[:-1] + ["zz"]), " ".join(WORDS), " ".join(reversed(WORDS)),
         "x <|endoftext|> y", "mail ab@c.de_f@g.hi, 4111 1111 1111 1111 and 10.0.0.1 +1 (23) 456-7890"]


@pytest.fixture(scope="module")
def docs(s):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None, "clash", 1) for i, t in enumerate(TEXTS)]
    return s.createDataFrame(rows + [rows[7], rows[12]], DOCS)


@pytest.fixture(scope="module")
def empty(s):
    return s.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_counts(docs, empty, tok):
    got = {r.doc_id: r for r in tokens.token_counts(docs).collect()}
    for i, t in enumerate(TEXTS):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 1024)
    assert tokens.token_counts(docs).count() == len(TEXTS) + 2 and not tokens.token_counts(empty).count()


def test_packing_round_trip(docs, empty, tok):
    rows = packing.pack(docs).collect()
    assert not packing.pack(empty).count()
    for r in rows:
        ids = np.array([*tok.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for key, at in (("row_id", "start"), ("sequence_id", "offset")):
        groups = {}
        for r in rows:
            groups.setdefault(r[key], []).append((r[at], r.length, r.doc_tokens))
        for g in groups.values():
            end = 0
            for start, length, _ in sorted(g):
                assert start == end
                end += length
            assert end == g[0][2] if key == "row_id" else end <= 1024 and end & end - 1 == 0


def test_language_held_out(s, docs, empty):
    d = table(s, SMALL, "documents")
    model = language.fit(d.where(~language.held_out()))
    r = language.language_mixtures(d, model).join(d.select("doc_id", "lang"), "doc_id").where(language.held_out())
    assert r.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] >= 0.95
    got = {x.doc_id: x for x in language.language_mixtures(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2))
    assert all(0 <= x.score <= 1 for x in got.values())
    nothing = language.fit(empty)
    assert {x.lang_pred for x in language.language_mixtures(docs, nothing).collect()} == {"und"}


def test_mixture_of_two_languages():
    like = np.array([[1.0, 0.01], [0.01, 1.0]])
    share = language.infer(like, np.array([[300, 100], [400, 0], [0, 0]]))
    assert abs(share[0, 0] - 0.75) < 0.02 and share[1].tolist() == [1, 0] and not share[2].any()


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


@pytest.mark.parametrize("light", [8, 1])
def test_jaccard_join_brute_force(s, empty, monkeypatch, light):
    monkeypatch.setattr(setjoin, "LIGHT", light)
    rng = np.random.default_rng(1)
    common = [f"c{i}" for i in range(25)]
    texts = list(TEXTS)
    for g in range(8):
        base = [f"v{x}" for x in rng.integers(0, 400, rng.integers(6, 120))] + common
        for _ in range(12):
            t = list(base)
            for _ in range(rng.integers(0, 6)):
                t[rng.integers(0, len(t))] = f"n{rng.integers(0, 9999)}"
            texts.append(" ".join(t))
    d = s.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: r for r in setjoin.link_documents(d).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == [(len(sets[i]), find(i)) for i in range(len(texts))]
    assert not setjoin.link_documents(empty).count()


@pytest.fixture(scope="module")
def vecs(s):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16))
    x[50:90] = x[50] + 0.03 * rng.standard_normal((40, 16))
    x[90:95] = x[90]
    rows = [(i, v.tolist(), None if i % 37 == 0 else i % 2) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] + [1.0] * 15, 1)]
    return s.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), x, rows


def test_near_vectors_brute_force(vecs):
    d, x, rows = vecs
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([-1 - i if r[2] is None else r[2] for i, r in enumerate(rows[:300])])
    hit = (u @ u.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(hit, False)
    comp = np.arange(300)
    while True:
        new = np.minimum(comp, np.where(hit, comp[None], 10 ** 6).min(1))
        if (new == comp).all():
            break
        comp = new
    got = {r.vec_id: r for r in vectors.link_vectors(d).collect()}
    assert [got[i].n_links for i in range(300)] == hit.sum(1).tolist()
    assert [got[i].component_id for i in range(300)] == comp.tolist()
    assert all(got[i].n_links == 0 and got[i].kept for i in range(1000, 1004))
    assert not vectors.link_vectors(d.limit(0)).count()


def test_nearest_recall(vecs):
    d, x, _ = vecs
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in neighbours.nearest(d).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q in range(0, 300, 50):
        score = u @ u[q]
        score[q] = -2
        hits += len(set(got[q]) & set(np.lexsort((np.arange(300), -score))[:5].tolist()))
    assert set(got) == set(range(0, 300, 50)) and hits >= 0.9 * 30
    assert not neighbours.nearest(d.limit(0)).count()


def test_quality_separates_labelled(s, docs, empty):
    d, labels = table(s, SMALL, "documents"), table(s, SMALL, "labels")
    scored, cut, ratios = quality.resample(d, labels)
    r = scored.join(labels, scored.id == labels.doc_id).groupBy("quality").agg(F.avg((F.col("key") >= cut).cast("double")).alias("kept"))
    kept = {x.quality: x.kept for x in r.collect()}
    assert kept[1] >= 0.9 and kept[0] <= 0.5
    assert quality.selected(docs, ratios, float("-inf")).columns == docs.columns
    assert quality.selected(docs, ratios, float("-inf")).where("doc_id < 3").count() == 0
    assert quality.resample(empty, labels)[0].count() == 0
    values = s.createDataFrame([(float(x),) for x in [3, 1, 2, 2, 9, -4]], "x double")
    assert [quality.kth_largest(values, "x", k) for k in (1, 2, 4, 6)] == [9, 3, 2, -4]


def test_main_text(s):
    page = ("<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><div class='cookie-notice'>we use</div>"
            "<article><h1>Head &amp; line</h1><p>A long  paragraph of the article, with\nwords.<p>Another one, just as long as that."
            "<ul><li>one<li>two</ul></article><div class=comments>nice!</div><footer>end</footer>")
    want = "Head & line\nA long paragraph of the article, with words.\nAnother one, just as long as that.\none\ntwo"
    assert main_text(page) == want
    d = s.createDataFrame([(1, "u", page, 3), (2, None, None, 3), (3, "u", "", 3), (3, "u", "", 3)], "page_id long, url string, html string, text int")
    got = extract_text(d).orderBy("page_id").collect()
    assert [(r.text, r.n_chars) for r in got] == [(want, len(want)), ("", 0), ("", 0), ("", 0)]


def test_mixing_targets_and_bounds(s, empty):
    d = table(s, SMALL, "documents")
    m = mixing.mix_sources(d)
    rows = m.documents.join(d.select("doc_id", "source"), "doc_id").collect()
    by = {}
    for r in rows:
        assert r.taken <= 2 * r["size"]
        x = by.setdefault(r.source, [0, r.target, r.source_size, 0])
        x[0] += r.taken
        x[3] += r["size"]
    assert all(abs(t - goal) <= 0.02 * goal + 64 and n == size for t, goal, size, n in by.values())
    assert abs(sum(x[1] for x in by.values()) - 1.5 * sum(x[2] for x in by.values())) < 1 or all(x[1] == 2 * x[2] for x in by.values())
    again = mixing.mix_sources(d).documents
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again.collect())
    assert mixing.mix_sources(empty).documents.count() == 0
    words = mixing.mixed_documents(d, m).select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words == sum(r.taken for r in rows)
    assert sorted(mixing.permuted(np.arange(100), np.full(100, 100), np.full(100, 7, np.uint64)).tolist()) == list(range(100))


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 16 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "phone": 8 <= len(d) <= 15}[kind]


def test_pii_base_and_contexts(s, docs, empty):
    odd = ["1.2.3.4.5.6.7.8 999.1.1.1", "é" * 9 + "x@y.zé", "x@y@z.com", "1" * 9000, "1 " * 5000, "+1" + "(" * 3000, "🙂 u.v@m1.example.com 🙂",
           " ".join(f"a{i}@b.cc 10.0.0.{i}" for i in range(400))]
    d = docs.select("doc_id", "text").union(s.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts = {**dict(enumerate(TEXTS)), **{100 + i: t for i, t in enumerate(odd)}}
    found = pii.find_pii(d).collect()
    assert len(found) == len(TEXTS) + 2 + len(odd)
    for r in found:
        assert [tuple(x) for x in r.base] == [(i, m.start(), m.end()) for i, k in enumerate(pii.KINDS)
                                              for m in re.finditer(PLAIN[k], texts[r.doc_id] or "") if good(k, m.group())]
    talk = ["reach me on mail bob@x.org now", "reach me on mail amy@y.org now", "reach me on mail kim@z.net now",
            "reach me on mail joe (at) corp (dot) com now", "meet at noon.today then 20240102 10 30"]
    d = s.createDataFrame(list(enumerate(talk)), "doc_id long, text string")
    spans = pii.find_pii(d)
    assert [r.x for r in spans.orderBy("doc_id").select(pii.joined(F.col("spans")).alias("x")).collect()] == ["email:17:26"] * 3 + ["email:17:40", ""]
    clean = d.join(spans, "doc_id").select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("x")).orderBy("doc_id")
    assert [r.x for r in clean.collect()][3:] == ["reach me on mail [EMAIL] now", talk[4]]
    assert not pii.find_pii(empty).count()
