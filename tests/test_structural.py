"""Structural join over interval-encoded nodes against a walk of the tree; deep pages; typed and kept page keys."""
import random

from pyspark.sql import functions as F

from offerboard.operators import nodes as N


def random_page(rnd):
    tags, out, open_ = ["div", "b", "i", "section"], [], []
    for _ in range(rnd.randint(1, 60)):
        if open_ and rnd.random() < 0.4:
            out.append(f"</{open_.pop()}>")
        else:
            tag = rnd.choice(tags)
            out.append(f"<{tag} class='{rnd.choice('xyz')}'>w")
            open_.append(tag)
    return "".join(out)


def test_nearest_enclosing_matches_a_tree_walk(spark):
    rnd = random.Random(7)
    pages = {f"p{i}": random_page(rnd) for i in range(60)}
    df = spark.createDataFrame(list(pages.items()), "page_id string, html string")
    nodes = N.html_nodes(df, columns=("pre", "post", "parent_pre", "depth", "tag", "attrs"))
    marked = nodes.select("page_id", "pre", "post", "depth", "tag", (F.col("attrs")["class"] == "x").alias("is_target"),
                          F.col("tag").isin("div", "b").alias("is_container"))
    got = {(r.page_id, r.pre): r.enclosing and r.enclosing.pre for r in N.nearest_enclosing(marked).collect()}
    want = {}
    for page, html in pages.items():
        rows = {r[0]: r for r in N.parse_nodes(html)[0]}
        for r in rows.values():
            if r[6]["class"] == "x":
                up = r[2]
                while up != -1 and rows[up][5] not in ("div", "b"):
                    up = rows[up][2]
                want[page, r[0]] = None if up == -1 else up
    assert got == want and any(v is None for v in got.values()) and any(v is not None for v in got.values())


def test_payload_of_the_container(spark):
    df = spark.createDataFrame([(1, "<div><p><b>x</b></p></div>")], "page_id long, html string")
    nodes = N.html_nodes(df)
    marked = nodes.select("page_id", "pre", "post", "depth", "start_offset", "end_offset", (F.col("tag") == "b").alias("is_target"),
                          (F.col("tag") == "div").alias("is_container"))
    row = N.nearest_enclosing(marked, ("pre", "start_offset", "end_offset")).first()
    assert (row.pre, tuple(row.enclosing)) == (2, (0, 0, 26))


def test_hundred_thousand_unclosed_tags(spark):
    n = 100_000
    html = "<div class='menu'>" + "<b>" * n + "<h2>Speiseplan</h2>montag"
    rows, text = N.parse_nodes(html)
    assert len(rows) == n + 2 and max(len(r) for r in rows) == 15 and text == "Speiseplanmontag"
    df = spark.createDataFrame([(1, html), (2, "<p>x</p>")], "page_id int, html string")
    nodes = N.html_nodes(df, columns=("pre", "post", "parent_pre", "depth", "tag", "attrs", "string_value", "text_start",
                                      "text_end", "has_text", "page_text"))
    assert nodes.count() == n + 3
    head = N.heading_container(nodes, container_tag="div", class_sub="menu").collect()
    assert [(r.page_id, r.pre, r.strategy) for r in head] == [(1, 0, "container")]
    word = N.keyword_container(nodes, ["montag"]).collect()
    assert [(r.page_id, r.pre) for r in word] == [(1, 0)]


def test_pages_keep_their_key_type_and_columns(spark):
    df = spark.createDataFrame([("a", "x.org", "<p>1<i>2"), (None, "y.org", "<b>3"), ("e", "z.org", None)], "url string, host string, html string")
    nodes = N.html_nodes(df, id_col="url", columns=("pre", "tag"), keys=("host",))
    assert nodes.schema.simpleString() == "struct<page_id:string,host:string,pre:int,tag:string>"
    assert sorted((r.page_id or "", r.host, r.pre, r.tag) for r in nodes.collect()) == [
        ("", "y.org", 0, "b"), ("a", "x.org", 0, "p"), ("a", "x.org", 1, "i")]


def test_long_pages_leave_the_parser_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS_A_BATCH", 3)
    df = spark.createDataFrame([(i, "<p>x" * i) for i in range(9)], "page_id long, html string").coalesce(1)
    got = {r.page_id: r.n for r in N.html_nodes(df, columns=("pre",)).groupBy("page_id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: i for i in range(1, 9)}


def test_headings_of_any_tag_by_their_span(spark):
    html = "<div class='group/container'><b>Spei<i>se</i>plan</b></div>"
    nodes = N.html_nodes(spark.createDataFrame([(1, html), (2, "<b>x</b>")], "page_id long, html string"))
    assert [(r.page_id, r.pre) for r in N.heading_container(nodes, heading_tag="b").collect()] == [(1, 0)]
