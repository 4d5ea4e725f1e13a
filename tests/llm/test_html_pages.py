"""Main text of pages that the sample tables do not have."""
import pytest

from offerboard.llm.htmltext import extract_text, main_text


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><![foo[x]]><p>b</p>", "a\nb"),
    ("<div><p>a</p></div><![foo[x]]><p>b</p>", "a\nb"),
    ("<p>a<![ <p>b</p>", "ab"),
    ("<p>a</p><![endif]><p>b</p>", "a\nb"),
    ("<p>a</p><![CDATA[x]]><p>b</p>", "a\nb"),
    ("<p>a</p><![foo", "a\n<![foo"),
    ("<p>a&#" + "9" * 5000 + ";</p><p>b&#" + "0" * 5000 + "65</p>", "a\ufffd\nbA"),
])
def test_marked_sections(page, want):
    assert main_text(page) == want


def test_marked_section_keeps_the_table(spark):
    d = spark.createDataFrame([(1, "u", "<p>a</p><![foo[x]]><p>b</p>"), (2, "u", "<p>c</p>")], "page_id long, url string, html string")
    assert [r.text for r in extract_text(d).orderBy("page_id").collect()] == ["a\nb", "c"]


LONG = "A paragraph of the article that goes on for many words, long enough to be content."
OTHER = "Another paragraph of the same article, with as many words and hardly any tags."


@pytest.mark.parametrize("wrap", [
    "<article class='post hentry comments-open'>%s</article>", "<article class='post category-search'>%s</article>",
    "<article class='article tag-social'>%s</article>", "<article class='search'>%s</article>",
    "<div class='has-sidebar'>%s</div>", "<div class='layout with-sidebar'>%s</div>", "<div id='sidebar'><article>%s</article></div>",
    "<div class='sidebar'><div role='search'><main>%s</main></div></div>", "<div class='form'>%s</div>"])
def test_names_discard_no_article(wrap):
    page = "<body><nav><a>menu</a></nav>" + wrap % f"<p>{LONG}</p><p>{OTHER}</p>" + "<div class='ad'>buy</div></body>"
    assert main_text(page) == LONG + "\n" + OTHER


@pytest.mark.parametrize("name", ["ad", "cookie-notice", "x sidebar", "site-footer", "comments", "share-links", "main_nav"])
def test_names_discard_furniture(name):
    assert main_text(f"<body><p>{LONG}</p><div class='{name}'>some words</div><p>{OTHER}</p></body>") == LONG + "\n" + OTHER


@pytest.mark.parametrize("name", ["category-search", "has-sidebar", "tag-social", "x-ad"])
def test_parts_of_names_discard_nothing(name):
    assert main_text(f"<body><p>{LONG}</p><p class='{name}'>some words</p><p>{OTHER}</p></body>") == LONG + "\nsome words\n" + OTHER


def test_names_discard_an_ad_longer_than_the_article():
    assert main_text(f"<body><div class='ad'>{LONG}</div><article><h1>Short words here</h1><p><b>Short words here.</b><br></article>") \
        == "Short words here\nShort words here."


MENU = "<div>" + "".join(f"<a href='/{i}'>m{i}</a>" for i in range(9)) + "</div>"
ROWS = "".join(f"<tr><td>item {i} of the long table with some words</td><td>{i}</td></tr>" for i in range(40))


@pytest.mark.parametrize("body, want", [
    # two sections, one far longer
    (f"<section><p>{LONG}</p><p>{OTHER}</p><p>{LONG}</p></section><section><h2>Second</h2><p>{OTHER}</p></section>",
     [LONG, OTHER, LONG, "Second", OTHER]),
    # an outer heading between the sections, and before them
    (f"<h1>Head</h1><section><p>{LONG}</p></section><h2>Then</h2><section><p>{OTHER}</p></section>", ["Head", LONG, "Then", OTHER]),
    # an outer heading and introduction
    (f"<h1>Head</h1><p>{OTHER}</p><div class='body'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", ["Head", OTHER, LONG, LONG, LONG]),
    (f"<h1>Head</h1><div class='body'><p>{LONG}</p><p>{LONG}</p></div>", ["Head", LONG, LONG]),
    # paragraphs around a long table
    (f"<p>{LONG}</p><table>{ROWS}</table><p>{OTHER}</p>",
     [LONG, *(x for i in range(40) for x in (f"item {i} of the long table with some words", str(i))), OTHER]),
    # lists are parts of what they stand in
    (f"<div><p>{LONG}</p><ul><li>one</li><li>two</li></ul><p>{OTHER}</p></div>", [LONG, "one", "two", OTHER]),
    # a page laid out by a table
    (f"<table><tr><td><p>{LONG}</p><p>{OTHER}</p><p>{LONG}</p></td></tr></table><p>{OTHER}</p>", [LONG, OTHER, LONG, OTHER]),
])
def test_pages_without_article(body, want):
    assert main_text(f"<body><nav><a>menu</a></nav>{body}<footer>end</footer></body>").split("\n") == want


def test_parts_without_content_are_left_out():
    page = f"<body>{MENU}<div><p>{LONG}</p><p>{OTHER}</p></div><div><p>{LONG}</p></div>{MENU}</body>"
    assert main_text(page).split("\n") == [LONG, OTHER, LONG]
