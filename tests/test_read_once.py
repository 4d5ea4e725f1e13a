"""What a page's or text's shuffle carries, how often it is read, and plain tags against the library's tokenizer."""
import contextlib
import io
import random
from html.parser import HTMLParser

import __spark_entry__ as entry
from conftest import SMALL
from offerboard.operators import clean as K
from offerboard.operators import menus as C
from offerboard.operators import nodes as N

PAGES = [(1, "<div class='a b'><p>Montag</p><table><tr><td>A</td></tr></table></div>")]


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def nodes(spark, **more):
    return N.html_nodes(spark.createDataFrame(PAGES, "page_id long, html string"), **more)


class Plain(N._TreeBuilder):
    """The same tree with every tag read by the library."""

    def feed(self, data):
        self.at, self.line_starts = None, [0]
        for x in data.split("\n")[:-1]:
            self.line_starts.append(self.line_starts[-1] + len(x) + 1)
        HTMLParser.feed(self, data)


def test_plain_tags_read_as_by_the_library(monkeypatch):
    parts = ["<p>", "</p>", "<P a=1>", '<a href="x&amp;y">', "</A >", "</ a>", "<br/>", "<b x='1' y>", "<script>", "</script>", "<style>",
             "</STYLE >", "<title>", "</title>", "text", " ", "\n", "&amp;", "&am", "&", "<", ">", "</", "<!--", "-->", "<?", "<!doctype html>",
             "<![x]]>", "</>", '<a b="', "<x:y>", "<td>", "<tr>", "<li>", "<table>", "</table>", "<a\xa0b='1'>", "<img a/b>", "<i A='1' a='2'/>", "</i"]
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    got = [N.parse_nodes(t) for t in texts]
    monkeypatch.setattr(N, "_TreeBuilder", Plain)
    plain = lambda rows, text: ([[*r[:7], "".join(r[7]), *r[8:]] for r in rows], text)
    for t, g in zip(texts, got):
        assert plain(*g) == plain(*N.parse_nodes(t)), t


def test_cleaned_pages_are_parsed_once(spark):
    assert plan(K.clean_nodes(nodes(spark, text_tags=(), columns=K.COLUMNS))).count("MapInArrow") == 1


def test_a_page_that_comes_twice_is_cleaned_twice(spark):
    df = spark.createDataFrame([(1, "<b>x<script>y</script></b>"), (1, "<b>x<script>y</script></b>"), (None, "<i>z</i>")], "page_id long, html string")
    got = sorted((r.page_id or 0, r.clean_html) for r in K.clean_nodes(N.html_nodes(df, text_tags=(), columns=K.COLUMNS)).collect())
    assert got == [(0, "<i>z</i>"), (1, "<b><b>x</b></b>"), (1, "<b><b>x</b></b>")]


def test_table_rows_are_read_before_the_shuffle(spark):
    shuffled = plan(C.table_pairs(nodes(spark, columns=C.HTML_MENU_COLUMNS))).split("Exchange")[0]
    assert "own_text" not in shuffled and "string_value" not in shuffled


def test_no_text_is_read_below_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "08.01.2024 - 12.01.2024\nMontag\nSuppe 1,00 €")], "doc_id long, text string").repartition(3, "doc_id")
    for df in (C.extract_text_menu(docs, keep_empty_days=False), C.to_lines(docs)):
        assert all("lambda" not in p.split("Exchange")[0] for p in plan(df).split("REPARTITION_BY_NUM")[1:])


def test_absent_words_bring_no_rows(spark):
    assert "size(split" not in plan(N.word_occurrences(nodes(spark), ["montag", "dienstag"]))


def test_parents_come_with_their_children(spark):
    for df in (N.parents_of_tag(nodes(spark), "td"), N.parents_of_class(nodes(spark), "div", "a")):
        assert "Generate" not in plan(df) and "Join" not in plan(df)
    bare = nodes(spark, columns=("pre", "parent_pre", "tag"))
    assert [tuple(r) for r in N.parents_of_tag(bare, "td").collect()] == [(1, 3, "tr")] == [tuple(r) for r in N.parents_of_tag(nodes(spark), "td").collect()]
    assert N.parents_of_tag(bare, "td", "table").collect() == []


def test_table_queries_shuffle_in_small_shares(spark):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    try:
        entry.queries()["page_titles"](spark, SMALL)
        assert [spark.conf.get(n) for n in names] == ["4m", "200"]
    finally:
        for n, v in zip(names, before):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
