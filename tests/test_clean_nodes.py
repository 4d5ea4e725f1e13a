"""The cleaner over nodes against a walk of the tree; killed, dropped and unknown elements; unsafe addresses; odd pages."""
import html as H
import random

import pytest

from offerboard.operators import clean as K
from offerboard.operators import nodes as N


def run(spark, pages, **more):
    df = spark.createDataFrame(list(pages.items()), "page_id string, html string")
    return {r.page_id: r.clean_html for r in K.clean_nodes(N.html_nodes(df, text_tags=(), columns=K.COLUMNS), **more).collect()}


def walk(page):
    """The cleaned page from the parsed rows and the page's text, element by element."""
    rows, text = N.parse_nodes(page)
    kids = {}
    for r in rows:
        kids.setdefault(r[2], []).append(r)

    def inside(parent, start, end):
        out, at = "", start
        for r in kids.get(parent, []):
            out += H.escape(text[at:r[8]], quote=False) + element(r)
            at = r[9]
        return out + H.escape(text[at:end], quote=False)

    def element(r):
        if r[5] in K.KILLED:
            return ""
        body = inside(r[0], r[8], r[9])
        if r[5] in K.DROPPED or r[5] not in K.KNOWN:
            return body
        attrs = "".join(f' {k}="{H.escape(v)}"'.replace("&#x27;", "'") for k, v in r[6].items() if k in K.SAFE)
        return f"<{r[5]}{attrs}>{body}" + ("" if r[5] in N.VOID_TAGS else f"</{r[5]}>")

    return inside(-1, 0, len(text))


def test_against_a_walk_of_the_tree(spark):
    rnd = random.Random(8)
    names = ["p", "div", "b", "object", "form", "madeup", "br", "li", "td", "select", "marquee", "noframes"]
    pages = {}
    for i in range(80):
        out = []
        for _ in range(rnd.randint(1, 40)):
            t, what = rnd.choice(names), rnd.random()
            out.append(f"<{t} title='a\"&lt;{i}' class=c>" if what < 0.45 else f"</{t}>" if what < 0.75 else rnd.choice(["x & y", "<!-- c -->", " < ", "<?pi?>"]))
        pages[f"p{i}"] = "".join(out)
    got = run(spark, pages)
    assert got == {k: walk(v) for k, v in pages.items() if N.parse_nodes(v)[0]}


@pytest.mark.parametrize("url, ok", [("javascript:x()", False), ("JAVA\tSCRIPT:x", False), (" vbscript:x", False), ("data:text/html,x", False),
                                     ("data:image/png;base64,x", True), ("/a?b=javascript:x", True), ("", True), ("https://x.org", True)])
def test_addresses(spark, url, ok):
    got = run(spark, {"p": f'<a href="{url}">x</a>'})["p"]
    assert got == f'<a href="{url if ok else ""}">x</a>'


def test_lists_are_parameters(spark):
    page = {"p": "<x-y id=a onclick=b><object>o</object><b>t</b></x-y>"}
    assert run(spark, page, kill=("b",), drop=("object",), known=None, safe=("id",))["p"] == '<x-y id="a">o</x-y>'
    assert run(spark, page, safe=())["p"] == "<b>t</b>"


def test_deep_and_odd_pages(spark):
    n = 20_000
    got = run(spark, {"deep": "<b>" * n + "x" + "</b>" * n, "open": "<p>a<object>b", "after": "<object>a</object>b", "none": "text only", "null": None,
                      "all": "<script>x</script>"})
    assert got == {"deep": "<b>" * n + "x" + "</b>" * n, "open": "<p>a</p>", "after": "b", "all": ""}
