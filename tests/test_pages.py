"""Page operators (section B) on small fixtures and a brute-force check of the node-table joins."""

from pyspark.sql import functions as F

from conftest import SMALL
from offerboard.operators import links as L
from offerboard.operators import nodes as N

LINKS_HTML = """<html><body>
<a href="/files/Mittagskarte_KW2.pdf">MITTAGSKARTE KW 2</a>
<a href="https://cdn.example.com/menu.png">Bild</a>
<a href="/img/woche.jpg">Speiseplan</a>
<a href="/about">speiseplan archiv</a>
<a href="/x.pdf">Ärzte MITTAGSKARTE</a>
</body></html>"""

SECTIONS_HTML = """<html><body>
<div id="p1"><section><p>no link</p></section>
  <section><a href="/a1.pdf">A1</a><a href="/a2.pdf">A2</a><a href="/a.html">html</a></section>
  <section><a href="/b1.pdf">B1</a></section></div>
<div id="p2"><section><a href="/c1.pdf">C1</a></section><section><a href="/d1.pdf">D1</a></section></div>
</body></html>"""

TABLES_HTML = {1: "<div><div><table><tr><td>a</td></tr></table></div></div>",
               2: "<div><div id='one'><table></table></div><div id='two'><table><tr><td>x</td></tr></table></div></div>",
               3: "<div><table></table></div><div><table></table></div><div><table></table></div>"}

WEEKLY_HTML = {1: "<div><p>nothing</p></div>",
               2: "<section><div class='foodMenu foodMenu--weekly'>W</div></section>",
               3: "<section><div class='foodMenu--weekly'>a</div></section><article><div class='foodMenu--weekly'>b</div></article>"}

HEADING_HTML = {
    1: "<div class='group/container x'><section><h2> Unser  SPEISEPLAN </h2><p>Montag: Suppe</p></section></div>",
    2: "<section id='s'><h2>Speiseplan KW 3</h2><p>x</p></section>",
    3: "<div class='menu'><div><p>Montag</p><p>Dienstag</p></div></div>",
    4: "<div><p>nothing here</p></div>",
}

DIRTY_HTML = ('<div class="c" style="x" onclick="evil()"><script>var t="</p>";</script><style>p{}</style>'
              '<!-- note --><iframe src="x"></iframe><object data="y">o</object>'
              '<a href="/a" target="_blank" title="t">A &amp; B</a><p>eins&nbsp;<b>zwei</p>'
              '<img src="i.png" alt="i" width="10"/></div>')


def _pages(spark, items):
    return spark.createDataFrame([(k, f"https://ex.org/{k}", v) for k, v in items.items()],
                                 "page_id bigint, url string, html string")


def test_links_filters(spark):
    pages = _pages(spark, {1: LINKS_HTML})
    links = L.extract_links(pages, keep=())
    assert links.count() == 5
    pdf_text = L.filter_links_text(links, "mittagskarte", href_any_of=["pdf"])
    assert sorted(r.href for r in pdf_text.collect()) == ["/files/Mittagskarte_KW2.pdf", "/x.pdf"]
    images = L.filter_links_href(links, [".png", ".jpg"])
    assert sorted(r.href for r in images.collect()) == ["/img/woche.jpg", "https://cdn.example.com/menu.png"]
    exact = L.filter_links_text(links, "Speiseplan", fold=False)
    assert [r.href for r in exact.collect()] == ["/img/woche.jpg"]
    absolute = L.absolutize(exact, "https://www.example.de")
    assert [r.url for r in absolute.collect()] == ["https://www.example.de/img/woche.jpg"]
    kept = L.absolutize(images.filter(F.col("href").startswith("http")), "https://www.example.de")
    assert [r.url for r in kept.collect()] == ["https://cdn.example.com/menu.png"]


def test_domain_filter(spark):
    pages = spark.createDataFrame(
        [(1, "https://www.example.de/a"), (2, "https://example.de/b"), (3, "https://badexample.de/c"),
         (4, "http://sub.shop.example.org:8080/x"), (5, "https://other.net/")], "page_id bigint, url string")
    got = sorted(r.page_id for r in L.domain_filter(pages, ["example.de", "shop.example.org"]).collect())
    assert got == [1, 2, 4]
    allow = spark.createDataFrame([("example.de",), ("shop.example.org",)], "domain string")
    assert sorted(r.page_id for r in L.domain_filter(pages, allow).collect()) == [1, 2, 4]


def test_first_section_links(spark):
    nodes = N.html_nodes(_pages(spark, {1: SECTIONS_HTML}))
    got = [r.href for r in N.links_in_first_section(nodes, "section", "a", "pdf").orderBy("pre").collect()]
    assert got == ["/a1.pdf", "/a2.pdf", "/c1.pdf"]


def test_table_parents_nth_and_count(spark):
    pages = _pages(spark, TABLES_HTML)
    nodes = N.html_nodes(pages)
    parents = N.parents_of_tag(nodes, "table", "div")
    counts = {r.page_id: (r.n_items, r.accepted) for r in L.expect_count(parents, pages, "page_id", "==", 2).collect()}
    assert counts == {1: (1, False), 2: (2, True), 3: (3, False)}
    accepted = parents.join(L.expect_count(parents, pages, "page_id", "==", 2).filter("accepted"), "page_id", "left_semi")
    second = N.block_html(N.nth_block(accepted, 1), nodes, pages).collect()
    assert [(r.page_id, r.block_html) for r in second] == [(2, "<div id='two'><table><tr><td>x</td></tr></table></div>")]


def test_weekly_parents(spark):
    pages = _pages(spark, WEEKLY_HTML)
    par = N.parents_of_class(N.html_nodes(pages), "div", "foodMenu--weekly")
    counts = {r.page_id: r.n_items for r in L.expect_count(par, pages, "page_id", "==", 1).collect()}
    assert counts == {1: 0, 2: 1, 3: 2}


def test_heading_and_keyword_containers(spark):
    pages = _pages(spark, HEADING_HTML)
    nodes = N.html_nodes(pages)
    primary = N.heading_container(nodes)
    fallback = N.keyword_container(nodes, ["montag", "dienstag"])
    chosen = N.block_html(N.coalesce_blocks(primary, fallback), nodes, pages)
    got = {r.page_id: (r.strategy, r.block_html[:30]) for r in chosen.collect()}
    assert got == {1: ("container", "<div class='group/container x'"),
                   2: ("parent", "<section id='s'><h2>Speiseplan"),
                   3: ("keyword", "<div class='menu'><div><p>Mont")}


def test_clean_and_text(spark):
    pages = _pages(spark, {1: DIRTY_HTML})
    r = L.page_text(L.clean_pages(pages, minify=True), html="clean_html").collect()[0]
    assert r.clean_html == ('<div><style>p{}</style><a href="/a" title="t">A &amp; B</a><p>eins&nbsp;<b>zwei</p>'
                            '<img src="i.png" alt="i" /></div>')
    assert "script" not in r.clean_html and "iframe" not in r.clean_html and "onclick" not in r.clean_html
    js = L.clean_pages(_pages(spark, {2: '<link rel="x"><meta name="m"><a href="javascript:evil()">j</a>'})).collect()[0]
    assert js.clean_html == '<a href="">j</a>'
    assert 'href="/a"' in r.clean_html and 'title="t"' in r.clean_html and 'target' not in r.clean_html
    assert r.text == "A & B\neins\nzwei"   # text lines drop style content
    sized = L.clean_pages(pages, safe_attrs=("src", "alt", "href", "title", "width", "height")).collect()[0]
    assert 'width="10"' in sized.clean_html


def test_meta_and_status(spark):
    pages = _pages(spark, {1: '<meta property="article:modified_time" content="2026-05-18T09:19:30+00:00">',
                           2: '<meta content="gestern" property="article:modified_time">', 3: "<p></p>"})
    got = {r.page_id: (r.meta_value, r.meta_valid, r.meta_ts is not None) for r in L.page_meta(pages).collect()}
    assert got == {1: ("2026-05-18T09:19:30+00:00", True, True), 2: ("gestern", False, False), 3: ("", False, False)}
    st = L.with_status(spark.createDataFrame([(None, "raw"), ("ok", "raw")], "c string, r string"), "c", "r")
    assert [(x.status, x.result) for x in st.collect()] == [("fallback", "raw"), ("ok", "ok")]


def _brute(rows):
    """Reference evaluation straight from the parsed tree, no joins."""
    by_pre = {r[0]: r for r in rows}
    def ancestors(r):
        p = r[2]
        while p != -1:
            yield by_pre[p]
            p = by_pre[p][2]
    li_parents = sorted({r[2] for r in rows if r[5] == "li" and by_pre.get(r[2], [None] * 6)[5] == "ul"})
    links = [r for r in rows if r[5] == "a" and "/" in r[6].get("href", "")]
    first = {}
    for s in rows:
        if s[5] == "ul" and any(s[0] in {a[0] for a in ancestors(l)} for l in links):
            first.setdefault(s[2], s[0])
    firsts = set(first.values())
    sec_links = sorted({l[0] for l in links if any(a[0] in firsts for a in ancestors(l))})
    return li_parents, sec_links


def test_node_joins_match_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    nodes = N.html_nodes(pages).cache()
    got_par = {}
    for r in N.parents_of_tag(nodes, "li", "ul").collect():
        got_par.setdefault(r.page_id, []).append(r.pre)
    got_sec = {}
    for r in N.links_in_first_section(nodes, "ul", "a", "/").collect():
        got_sec.setdefault(r.page_id, []).append(r.pre)
    for p in pages.collect():
        par, sec = _brute(N.parse_nodes(p.html, ())[0])
        assert sorted(got_par.get(p.page_id, [])) == par
        assert sorted(got_sec.get(p.page_id, [])) == sec
    nodes.unpersist()


def test_spans_match_string_values(spark):
    """Span-based containment equals a test on each element's full string value."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    nodes = N.html_nodes(pages, text_tags=None).cache()
    words = ["the", "nicht", "ou"]
    got = {(r.page_id, r.pre) for r in N.elements_containing(nodes, words).collect()}
    from offerboard.functions.text import ascii_fold
    want = {(r.page_id, r.pre) for r in nodes.filter(
        ascii_fold(F.col("string_value")).contains("the") | ascii_fold(F.col("string_value")).contains("nicht")
        | ascii_fold(F.col("string_value")).contains("ou")).collect()}
    assert got == want and len(got) > 0
    split_word = N.html_nodes(spark.createDataFrame([(1, "<div><p>Mon<b>TAG</b></p><p>x</p></div>")], "page_id bigint, html string"))
    assert {r.pre for r in N.elements_containing(split_word, ["montag"]).collect()} == {0, 1}
    nodes.unpersist()


def test_links_from_nodes(spark):
    html = '<p><a href="/a.pdf"><img src="x.png"> Plan <b>KW&nbsp;2</b></a><a href="/b">B &amp; C</a><a name="x">n</a></p>'
    nodes = N.html_nodes(spark.createDataFrame([(1, html)], "page_id bigint, html string"))
    got = [(r.href, r.text) for r in N.links_from_nodes(nodes).orderBy("pos").collect()]
    assert got == [("/a.pdf", " Plan KW\xa02"), ("/b", "B & C"), (None, "n")]
    flat = L.extract_links(spark.createDataFrame([(1, html)], "page_id bigint, html string"), keep=())
    assert [(r.pos, r.href, r.text) for r in flat.collect()] == [(0, "/a.pdf", " Plan KW\xa02"), (1, "/b", "B & C")]
    odd = L.extract_links(spark.createDataFrame([(1, "<a class=x href='/c'>c</a><a href=/d>d</a><a name=n>n</a><a href=\"\">e</a>")],
                                                "page_id bigint, html string"), keep=())
    assert [(r.href, r.text) for r in odd.collect()] == [("/c", "c"), ("/d", "d"), ("", "e")]
