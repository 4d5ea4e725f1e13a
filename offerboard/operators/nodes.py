"""The node table of a page (B1) and the structural selections built on it.

``html_nodes`` is the package's one Python stage: a ``mapInArrow`` over the
page key and its HTML that tokenizes each page with the standard library parser
and emits one row per element, numbered in pre- and post-order. After that
every XPath-like question is a window or an ordinary join:

* parent / child         -> equi-join on ``(page_id, parent_pre = pre)``
* ancestor / descendant  -> interval encoding: an element holds another when it
                            opens before and closes after it. Windows over the
                            page's sorted opens and closes answer "holds any",
                            "is inside any" and "nearest enclosing" in one pass
* "first" / "n-th"       -> aggregate ``min(pre)`` or a window bounded by one page
* contains(string(.), w) -> occurrences of w in the page text matched to element
                            text spans by one window per page (no element text stored)

No pair of elements is formed for an ancestor test, and a node row holds no
ancestor list: rows and windows are linear in the page, however deep it nests.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from offerboard.functions.html import page_title, wrap_document
from offerboard.functions.text import ascii_fold, normalize_space

# column -> type, beside the page's own key
NODE_COLUMNS = {
    "pre": "int", "post": "int", "parent_pre": "int", "parent_tag": "string", "depth": "int", "sib": "int", "tag": "string",
    "attrs": "map<string,string>", "own_text": "string", "string_value": "string", "text_start": "int", "text_end": "int",
    "has_text": "boolean", "page_text": "string", "start_offset": "int", "end_offset": "int",
    "before_start": "string", "before_end": "string", "after_page": "string",
}

# Elements without content, and elements whose start closes an
# open paragraph (HTML parsing rules, abridged).
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
             "source", "track", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
            "table", "ul"}
# Elements whose full text (XPath string value) is stored by default: headings,
# table cells, links and the title. Other elements are matched against the page
# text through their text span.
TEXT_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "a", "title")

ROWS_A_BATCH = 20_000        # node rows that leave the parser in one piece

_XML_WS = " \t\r\n"
_MAY_CLOSE = CLOSES_P | {"li", "td", "th", "tr"}

# Tags in the form nearly all have: a name, attributes without a value or with a quoted one. The library's
# tokenizer reads every other form.
_PLAIN_START = re.compile(r"""<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n\f]+[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:="[^"]*"|='[^']*')?)*)[ \t\r\n\f]*(/?)>""")
_PLAIN_ATTR = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:="([^"]*)"|='([^']*)')?""")
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)[ \t\r\n\f]*>")
# elements whose content is no markup: their start goes through the library, which knows the rules of each
_RAW = {*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"}
_ATTRS_KEPT, _ATTRS_LEN = 4096, 300      # attribute texts that are read once for all pages, and the longest of them
_known: dict[str, dict[str, str]] = {}


def _read_attrs(attrs: str) -> dict[str, str]:
    out = _known.get(attrs)
    if out is None:
        out = {}
        for k, double, single in _PLAIN_ATTR.findall(attrs):
            value = double or single
            out.setdefault(k.lower(), unescape(value) if "&" in value else value)
        if len(attrs) <= _ATTRS_LEN:
            if len(_known) >= _ATTRS_KEPT:
                _known.clear()
            _known[attrs] = out
    return out


class _TreeBuilder(HTMLParser):
    """Builds node rows; the text of all elements forms one stream, each element owns a span of it."""

    def __init__(self, html: str, text_tags):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.text_tags = text_tags           # None: every element keeps its string value
        self.rows: list[list] = []
        self.stack: list[int] = []           # indexes into rows of open elements
        self.open: list[str] = []            # their tags
        self.n_open: Counter = Counter()     # how many of each tag are open
        self.children: list[int] = [0]       # element-children count per open level (root level first)
        self.chunks: list[str] = []          # the page's text stream
        self.text_len = 0
        self.pre = 0
        self.post = 0
        self.tagged = 0                      # text read before the last tag
        self.at: int | None = 0              # where the tag being read starts; None: the library's position tells
        self.line_starts: list[int] = []

    # row layout: 0 pre, 1 post, 2 parent_pre, 3 depth, 4 sib, 5 tag, 6 attrs, 7 own_text(list),
    #             8 text_start, 9 text_end, 10 has_text, 11 start, 12 end,
    #             13 text since the last tag before the start, 14 before the end (both where that text begins)
    def _offset(self) -> int:
        if self.at is not None:
            return self.at
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def feed(self, data: str) -> None:
        """One whole page: text and plain tags are read here, any other construct by the library's method for it.

        What no method can finish (markup cut off by the page's end) stays with
        the library's own loop, which goes on from there.
        """
        self.rawdata, i, n = data, 0, len(data)
        find, start_tag, end_tag = data.find, _PLAIN_START.match, _PLAIN_END.match
        while i < n:
            j = find("<", i)
            if j != i:
                text = data[i:j] if j > 0 else data[i:]
                self.handle_data(unescape(text) if "&" in text else text)
                if j < 0:
                    i = n
                    break
                i = j
            self.at = i
            c = data[i + 1:i + 2]
            if c == "/":
                m = end_tag(data, i)
                if m:
                    i = m.end()
                    tag = m[1].lower()
                    if self.n_open[tag]:
                        self._close(tag, self.at, i)
                    continue
                k = self.parse_endtag(i)
            elif c.isascii() and c.isalpha():
                m = start_tag(data, i)
                if m and (tag := m[1].lower()) not in _RAW:
                    attrs = m[2]
                    i = m.end()
                    self._open(tag, _read_attrs(attrs) if attrs else {}, self.at,
                               i if m[3] or tag in VOID_TAGS else None)
                    continue
                k = self.parse_starttag(i)
                if self.cdata_elem is not None:
                    # its content, up to the end tag
                    m = self.interesting.search(data, k)
                    if not m:
                        i = k
                        break
                    if k < m.start():
                        if getattr(self, "_escapable", False):
                            i = k
                            break
                        self.handle_data(data[k:m.start()])
                    i = self.at = m.start()
                    k = self.parse_endtag(i)
                    if k >= 0 and self.cdata_elem is not None:
                        i = k
                        break
            elif c == "!":
                k = self.parse_comment(i) if data.startswith("<!--", i) else self.parse_html_declaration(i)
            elif c == "?":
                k = self.parse_pi(i)
            elif c:
                self.handle_data("<")
                k = i + 1
            else:
                break
            if k < 0:
                break
            i = k
        if i < n:
            # offset of each line start, for turning the library's (line, column) into offsets
            self.line_starts = [0, *accumulate(len(x) + 1 for x in data.split("\n")[:-1])]
            self.at = None
            self.updatepos(0, i)
            self.rawdata = data[i:]
            self.goahead(0)
        else:
            self.rawdata = ""

    def parse_marked_section(self, i, report=1):
        # "<![foo[x]]>" outside of foreign content is a comment up to the next ">"
        return self.parse_bogus_comment(i)

    def _close_top(self, end: int) -> None:
        i = self.stack.pop()
        self.n_open[self.open.pop()] -= 1
        self.children.pop()
        row = self.rows[i]
        row[1] = self.post
        self.post += 1
        row[9] = self.text_len
        row[12] = end
        row[14] = self.tagged
        self.tagged = self.text_len
        if row[10] and self.stack:
            self.rows[self.stack[-1]][10] = True

    def _implicit_close(self, tag: str, start: int) -> None:
        if tag in CLOSES_P and self.open and self.open[-1] == "p":
            self._close_top(start)
        elif tag == "li" and self.n_open["li"]:
            self._close_to(("li",), ("ul", "ol"), start)
        elif tag in ("td", "th") and (self.n_open["td"] or self.n_open["th"]):
            self._close_to(("td", "th"), ("tr", "table"), start)
        elif tag == "tr" and self.n_open["tr"]:
            self._close_to(("tr",), ("table",), start)

    def _close_to(self, tags, barriers, start: int) -> None:
        """Close the innermost of ``tags`` and all within it, as far as the next barrier."""
        while self.open and self.open[-1] not in tags and self.open[-1] not in barriers:
            self._close_top(start)
        if self.open and self.open[-1] in tags:
            self._close_top(start)

    def _start(self, tag: str, attrs, self_closing: bool) -> None:
        start = self._offset()
        amap: dict[str, str] = {}
        for k, v in attrs:
            amap.setdefault(k.lower(), "" if v is None else v)
        empty = self_closing or tag in VOID_TAGS
        self._open(tag, amap, start, start + len(self.get_starttag_text() or "") if empty else None)

    def _open(self, tag: str, amap: dict[str, str], start: int, end: int | None) -> None:
        """A new element; ``end`` is where its start tag ends if it has no content."""
        if tag in _MAY_CLOSE and self.open:
            self._implicit_close(tag, start)
        rows, stack = self.rows, self.stack
        self.n_open[tag] += 1
        rows.append([self.pre, -1, rows[stack[-1]][0] if stack else -1, len(stack), self.children[-1], tag, amap, [], self.text_len, -1, False,
                     start, -1, self.tagged, -1])
        self.children[-1] += 1
        self.tagged = self.text_len
        self.pre += 1
        stack.append(len(rows) - 1)
        self.open.append(tag)
        self.children.append(0)
        if end is not None:
            self._close_top(end)

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, False)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, True)

    def handle_endtag(self, tag):
        if not self.n_open[tag]:
            return
        pos = self._offset()
        gt = self.html.find(">", pos)
        self._close(tag, pos, len(self.html) if gt < 0 else gt + 1)

    def _close(self, tag: str, pos: int, end: int) -> None:
        """The innermost open ``tag`` ends, and all within it where its end tag starts."""
        while self.open[-1] != tag:
            self._close_top(pos)
        self._close_top(end)

    def handle_data(self, data):
        self.chunks.append(data)
        self.text_len += len(data)
        if not self.stack:      # text outside every element is part of the page's text alone
            return
        top = self.rows[self.stack[-1]]
        top[7].append(data)
        if not top[10] and data.strip(_XML_WS):
            top[10] = True

    def finish(self) -> tuple[list[list], str]:
        while self.stack:
            self._close_top(len(self.html))
        return self.rows, "".join(self.chunks)


def parse_nodes(html: str, text_tags=TEXT_TAGS) -> tuple[list[list], str]:
    """(node rows, page text) of one page; pure Python, also the tests' brute-force reference.

    ``text_tags``: elements whose string value is kept (``None`` keeps all).
    """
    b = _TreeBuilder(html or "", None if text_tags is None else frozenset(text_tags))
    try:
        b.feed(html or "")
        b.close()
    except AssertionError:   # the tokenizer gives up within a declaration: the nodes read so far stay
        pass
    return b.finish()


def _cells(name: str, rows: list[list], text: str, text_tags, page=None) -> list:
    """One column of a page's node rows (``page``: all rows of the page, if these are a part of them)."""
    at = {"pre": 0, "post": 1, "parent_pre": 2, "depth": 3, "sib": 4, "tag": 5, "text_start": 8, "text_end": 9,
          "has_text": 10, "start_offset": 11, "end_offset": 12}
    if name in at:
        return [r[at[name]] for r in rows]
    if name == "attrs":
        return [list(r[6].items()) for r in rows]
    if name == "parent_tag":
        page = rows if page is None else page
        return [page[r[2]][5] if r[2] >= 0 else None for r in rows]
    if name == "own_text":
        return ["".join(r[7]) for r in rows]
    if name == "before_start":
        return [text[r[13]:r[8]] for r in rows]
    if name == "before_end":
        return [text[r[14]:r[9]] for r in rows]
    if name == "after_page":
        last = max((r[9] for r in rows), default=0)
        return [text[last:] if r[0] == 0 else None for r in rows]
    if name == "page_text":
        return [text if r[0] == 0 else None for r in rows]
    return [text[r[8]:r[9]] if text_tags is None or r[5] in text_tags else None for r in rows]


def _arrow_type(ddl: str) -> pa.DataType:
    return {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
            "map<string,string>": pa.map_(pa.string(), pa.string())}[ddl]


def html_nodes(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               text_tags=TEXT_TAGS, columns=tuple(NODE_COLUMNS), keys=()) -> DataFrame:
    """B1: one row per element of every page.

    Columns: page_id (of the pages' own type), the pages' columns named by
    ``keys``, and those of ``columns``: pre, post, parent_pre, parent_tag, depth,
    sib (element index among siblings), tag, attrs, own_text (direct text),
    string_value (XPath ``string(.)``, kept for ``text_tags`` only; ``None``
    keeps it for all), text_start/text_end (the element's span in the page
    text), has_text (some non-white-space text below), page_text (the page's
    whole text, on the row with pre 0 only), start_offset/end_offset (outer
    HTML span in the page), before_start/before_end (the text between the tag
    before and the element's start or end) and after_page (text after the last
    tag, on the row with pre 0). Only the columns asked for are built and leave
    the parser.

    Storing every element's string value would repeat the page text once per
    nesting level; the spans give the same answers for "contains" tests
    (``elements_containing``) at the cost of the text once. Filter pages
    before calling this; only the keys and the HTML cross into Python.
    """
    # ship this module's parser with the task so executors need no install of the package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    tags = None if text_tags is None else frozenset(text_tags)
    types = [_arrow_type(NODE_COLUMNS[c]) for c in columns]
    names = ["page_id", *keys, *columns]

    def parse(batches):
        for b in batches:
            first, count, held, n = 0, [], [[] for _ in columns], 0

            def flush():
                repeat = pa.array([i for i, n in enumerate(count, first) for _ in range(n)], pa.int64())
                kept = [b.column(k).take(repeat) for k in range(1 + len(keys))]
                return pa.RecordBatch.from_arrays(kept + [pa.array(v, t) for v, t in zip(held, types)], names=names)

            for i, html in enumerate(b.column(1 + len(keys))):
                rows, text = parse_nodes(html.as_py(), tags)
                # one long page leaves in several pieces too
                for j in range(0, len(rows), ROWS_A_BATCH):
                    part = rows[j:j + ROWS_A_BATCH]
                    count += [0] * (i + 1 - first - len(count))
                    count[i - first] += len(part)
                    for v, c in zip(held, columns):
                        v += _cells(c, part, text, tags, rows)
                    n += len(part)
                    if n >= ROWS_A_BATCH:
                        yield flush()
                        first, count, held, n = i, [], [[] for _ in columns], 0
            if n:
                yield flush()

    kind = lambda c: pages.schema[c].dataType.simpleString()
    schema = ", ".join([f"page_id {kind(id_col)}", *[f"`{k}` {kind(k)}" for k in keys],
                        *[f"{c} {NODE_COLUMNS[c]}" for c in columns]])
    return pages.select(F.col(id_col).alias("page_id"), *keys, F.col(html_col).alias("_html")).mapInArrow(parse, schema)


def page_texts(nodes: DataFrame) -> DataFrame:
    """(page_id, page_text): the text stream the spans of ``html_nodes`` point into."""
    return nodes.filter(F.col("pre") == 0).select("page_id", "page_text")


def word_occurrences(nodes: DataFrame, words, fold: bool = True) -> DataFrame:
    """(page_id, occ_start, occ_end) of every occurrence of any word in each page text.

    Each page text is paired with each word (a literal array, exploded), split
    on the word, and the piece lengths summed in a window over that page and
    word give the offsets; a word that the text does not hold brings no
    row. One pass for all words; exact across tag boundaries, because the page
    text is the concatenation of all text nodes.
    """
    text = page_texts(nodes)
    t = ascii_fold(F.col("page_text")) if fold else F.col("page_text")
    ws = F.array(*[F.struct(F.lit(_regex_literal(w)).alias("pattern"), F.lit(len(w)).alias("len"), F.lit(w).alias("word")) for w in words])
    held = lambda w: F.contains(F.col("_t"), w["word"])
    # outer: otherwise the planner adds a filter that works out each list a second time
    pairs = text.select("page_id", t.alias("_t")).select("page_id", "_t", F.explode_outer(F.filter(ws, held)).alias("_w")).filter(F.col("_w").isNotNull())
    pieces = pairs.select("page_id", F.col("_w.pattern").alias("_pat"), F.col("_w.len").alias("_len"),
                          F.posexplode_outer(F.split(F.col("_t"), F.col("_w.pattern"), -1)).alias("k", "piece"))
    by_word = Window.partitionBy("page_id", "_pat")
    upto = by_word.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    occ = (pieces.withColumn("_start", F.sum(F.length("piece") + F.col("_len")).over(upto) - F.col("_len"))
           .withColumn("_n", F.count(F.lit(1)).over(by_word))
           .filter(F.col("k") < F.col("_n") - 1))
    return occ.select("page_id", F.col("_start").cast("int").alias("occ_start"),
                      (F.col("_start") + F.col("_len")).cast("int").alias("occ_end"))


def _regex_literal(w: str) -> str:
    # Java regex quoting: the word is matched literally
    return "\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def elements_containing(nodes: DataFrame, words, fold: bool = True) -> DataFrame:
    """Elements whose (folded) string value holds any word: (page_id, pre, post, parent_pre, depth).

    Element spans and word occurrences are merged into one sequence per page
    ordered by position, read from the end of the page: the running minimum of
    occurrence ends over everything at or after an element's span start says
    whether some occurrence starts inside the span and ends before it does.
    One window per page, linear in its rows, and no element text is
    materialised.
    """
    own = ["pre", "post", "parent_pre", "depth", "text_end"]
    occ = word_occurrences(nodes, words, fold).select(
        "page_id", F.col("occ_start").alias("_p"), F.lit(1).alias("_kind"), F.col("occ_end").alias("_occ_end"),
        *[F.lit(None).cast("int").alias(c) for c in own])
    # an element without text holds no word
    el = (nodes.filter(F.col("text_end") > F.col("text_start")) if all(words) else nodes).select("page_id", F.col("text_start").alias("_p"), F.lit(0).alias("_kind"),
                      F.lit(None).cast("int").alias("_occ_end"), *own)
    w = (Window.partitionBy("page_id").orderBy(F.col("_p").desc(), F.col("_kind").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = el.unionByName(occ).withColumn("_min_end", F.min("_occ_end").over(w))
    return merged.filter((F.col("_kind") == 0) & (F.col("_min_end") <= F.col("text_end"))) \
        .select("page_id", "pre", "post", "parent_pre", "depth")


def _attr_contains(attr: str, sub: str) -> Column:
    return F.coalesce(F.col("attrs")[attr].contains(sub), F.lit(False))


def _text_has(words, col: str = "string_value", fold: bool = True) -> Column:
    # normalize-space only changes a match when a word holds white space itself
    t = normalize_space(F.col(col)) if any(any(ch.isspace() for ch in w) for w in words) else F.col(col)
    if fold:
        t = ascii_fold(t)
    cond = F.lit(False)
    for w in words:
        cond = cond | t.contains(w)
    return F.coalesce(cond, F.lit(False))


def nearest_enclosing(marked: DataFrame, payload=("pre",)) -> DataFrame:
    """Structural join: every target with the nearest container around it.

    ``marked`` holds (page_id, pre, post, depth, is_target, is_container, ...)
    for the elements that matter. In the sequence of a page's start and end
    tags an element opens at ``2 pre - depth`` and closes at ``2 post + depth +
    1``. A running count of opens minus closes over the sorted events gives
    each one the height of the container stack. Containers of one height do
    not overlap, so a target of height h lies in the container of that height
    that opened last. Two windows over one partitioning by page; no ancestor
    pairs, no lists.
    -> the targets' rows with ``enclosing`` (struct of ``payload``, NULL where
    no container encloses the target; an element does not enclose itself)
    """
    kept = [c for c in marked.columns if c not in ("is_target", "is_container")]
    event = lambda at, order, step: F.struct(at.alias("at"), F.lit(order).alias("kind"), F.lit(step).alias("step"))
    opens = 2 * F.col("pre") - F.col("depth")
    closes = 2 * F.col("post") + F.col("depth") + 1
    nothing = F.array().cast("array<struct<at:int,kind:int,step:int>>")
    # at one place a target comes before the container that it is itself
    events = F.concat(F.when(F.col("is_target"), F.array(event(opens, 0, 0))).otherwise(nothing),
                      F.when(F.col("is_container"), F.array(event(opens, 1, 1), event(closes, 1, -1))).otherwise(nothing))
    stack = marked.select(*kept, F.explode(events).alias("_e"))
    upto = lambda w: w.orderBy("_e.at", "_e.kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    high = (stack.withColumn("_height", F.sum("_e.step").over(upto(Window.partitionBy("page_id"))))
            .filter(F.col("_e.step") >= 0))
    opened = F.when(F.col("_e.kind") == 1, F.struct(*payload))
    return (high.withColumn("enclosing", F.when(F.col("_height") > 0, F.last(opened, ignorenulls=True)
                                                .over(upto(Window.partitionBy("page_id", "_height")))))
            .filter(F.col("_e.kind") == 0).select(*kept, "enclosing"))


def holds_any() -> Column:
    """Whether an element holds a target (rows of ``marked`` as for ``nearest_enclosing``).

    Elements in document order: the next target after an element is inside it
    exactly when it closes first, since a subtree is contiguous.
    """
    after = Window.partitionBy("page_id").orderBy("pre").rowsBetween(1, Window.unboundedFollowing)
    return F.coalesce(F.first(F.when(F.col("is_target"), F.col("post")), ignorenulls=True).over(after) < F.col("post"), F.lit(False))


def inside_any(container: Column) -> Column:
    """Whether an element lies in one for which ``container`` holds: of those opened before, one closes after it."""
    before = Window.partitionBy("page_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.max(F.when(container, F.col("post"))).over(before) > F.col("post"), F.lit(False))


def links_from_nodes(nodes: DataFrame, link_tag: str = "a") -> DataFrame:
    """B3 for any markup: (page_id, pos, href, text) of every anchor, nested content included.

    ``pos`` is the anchor's document-order position; text is its whole string
    value (entities decoded by the tokenizer). Anchors without href keep NULL.
    """
    return nodes.filter(F.col("tag") == link_tag).select(
        "page_id", F.col("pre").cast("bigint").alias("pos"), F.col("attrs")["href"].alias("href"),
        F.col("string_value").alias("text"))


def links_in_first_section(nodes: DataFrame, container: str = "section", link_tag: str = "a",
                           href_contains: str = "pdf") -> DataFrame:
    """``//container[.//a[contains(@href,x)]][1]//a[contains(@href,x)]`` -> (page_id, pre, href).

    ``[1]`` counts per parent: for every parent the first child container that
    holds a matching link is kept, and all matching links below it returned.
    Three windows over one partitioning by page, on links and containers only.
    """
    href = F.col("attrs")["href"]
    marked = nodes.select(
        "page_id", "pre", "post", "parent_pre", href.alias("href"), (F.col("tag") == container).alias("is_container"),
        ((F.col("tag") == link_tag) & F.coalesce(href.contains(href_contains), F.lit(False))).alias("is_target")) \
        .filter(F.col("is_target") | F.col("is_container"))
    marked = marked.withColumn("_holds", F.col("is_container") & holds_any())
    siblings = Window.partitionBy("page_id", "parent_pre")
    marked = marked.withColumn("_first", F.col("_holds") & (F.col("pre") == F.min(F.when(F.col("_holds"), F.col("pre"))).over(siblings)))
    return marked.withColumn("_inside", inside_any(F.col("_first"))).filter(F.col("is_target") & F.col("_inside")) \
        .select("page_id", "pre", "href")


def _parents(nodes: DataFrame, is_child: Column, parent_tag: str | None = None) -> DataFrame:
    """Distinct parents of the elements of one kind; a child's row names its parent, so no other row is shuffled."""
    child = nodes.filter(is_child)
    if "parent_tag" not in nodes.columns:
        own = nodes.select(F.col("page_id").alias("_id"), F.col("pre").alias("_pre"), F.col("tag").alias("parent_tag"))
        child = child.join(own, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("parent_pre") == F.col("_pre")))
    named = F.col("parent_tag").isNotNull() if parent_tag is None else F.col("parent_tag") == parent_tag
    return child.filter(named).select("page_id", F.col("parent_pre").alias("pre"), F.col("parent_tag").alias("tag")).distinct()


def parents_of_tag(nodes: DataFrame, tag: str, parent_tag: str | None = None) -> DataFrame:
    """Distinct parents (of ``parent_tag``, or any) of ``tag`` elements -> (page_id, pre, tag)."""
    return _parents(nodes, F.col("tag") == tag, parent_tag)


def parents_of_class(nodes: DataFrame, tag: str, class_sub: str) -> DataFrame:
    """``//tag[contains(@class, sub)]/parent::*`` -> (page_id, pre, tag)."""
    return _parents(nodes, (F.col("tag") == tag) & _attr_contains("class", class_sub))


def nth_block(blocks: DataFrame, n: int) -> DataFrame:
    """The n-th (0-based) block of each page in document order.

    The window is bounded by one page's candidate blocks.
    """
    w = Window.partitionBy("page_id").orderBy("pre")
    return blocks.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == n + 1).drop("_rn")


def heading_container(nodes: DataFrame, heading_tag: str = "h2", word: str = "speiseplan",
                      container_tag: str = "div", class_sub: str = "group/container") -> DataFrame:
    """Container of the heading; the nearest matching ancestor, else the heading's parent.

    Headings: ``heading_tag`` whose folded, whitespace-normalised text holds
    ``word``. Per page the first container in document order wins; parents
    are only used when no heading has a matching ancestor.
    -> (page_id, pre, strategy)
    """
    if heading_tag in TEXT_TAGS:             # the node table holds the heading's text
        is_head = (F.col("tag") == heading_tag) & _text_has([word])
        held = nodes
    else:                                    # span test, works for any tag
        hit = elements_containing(nodes, [word]).select("page_id", F.col("pre").alias("_hit"))
        held = nodes.join(hit, (nodes["page_id"] == hit["page_id"]) & (nodes["pre"] == hit["_hit"]), "left").drop(hit["page_id"])
        is_head = (F.col("tag") == heading_tag) & F.col("_hit").isNotNull()
    is_cont = (F.col("tag") == container_tag) & _attr_contains("class", class_sub)
    marked = held.select("page_id", "pre", "post", "depth", "parent_pre", is_head.alias("is_target"), is_cont.alias("is_container")) \
        .filter(F.col("is_target") | F.col("is_container"))
    heads = nearest_enclosing(marked)
    # per page the first container in document order, or else the first heading's parent
    choice = F.when(F.col("enclosing").isNotNull(), F.struct(F.lit(1).alias("prio"), F.col("enclosing.pre").alias("pre"))) \
        .otherwise(F.struct(F.lit(2).alias("prio"), F.col("parent_pre").alias("pre")))
    best = heads.groupBy("page_id").agg(F.min(choice).alias("b"))
    return best.select("page_id", F.col("b.pre").alias("pre"),
                       F.when(F.col("b.prio") == 1, F.lit("container")).otherwise(F.lit("parent")).alias("strategy"))


def keyword_container(nodes: DataFrame, words, container_tag: str = "div") -> DataFrame:
    """Nearest classed, non-empty ``container_tag`` around the first innermost keyword match.

    An element matches when its folded text holds any word; innermost means no
    element child matches as well. Matching is closed upwards and a subtree is
    contiguous in pre-order, so a match has a matching child exactly when the
    next match in document order lies inside it: one ``lead`` over the
    page's matches, no self-join. -> (page_id, pre, strategy)
    """
    m = elements_containing(nodes, words)
    nxt = F.lead("post").over(Window.partitionBy("page_id").orderBy("pre"))
    innermost = m.withColumn("_next_post", nxt).filter(
        F.col("_next_post").isNull() | (F.col("_next_post") > F.col("post")))
    first = innermost.groupBy("page_id").agg(F.min_by(F.struct("pre", "post", "depth"), "pre").alias("_t")) \
        .select("page_id", "_t.*", F.lit(True).alias("is_target"), F.lit(False).alias("is_container"))
    # string-length(normalize-space(.)) > 0  <=>  some character below that is not XML white space
    divs = nodes.filter((F.col("tag") == container_tag) & F.col("attrs")["class"].isNotNull() & F.col("has_text")) \
        .select("page_id", "pre", "post", "depth", F.lit(False).alias("is_target"), F.lit(True).alias("is_container"))
    return (nearest_enclosing(first.unionByName(divs)).filter(F.col("enclosing").isNotNull())
            .select("page_id", F.col("enclosing.pre").alias("pre"), F.lit("keyword").alias("strategy")))


def coalesce_blocks(*strategies: DataFrame) -> DataFrame:
    """Per page the block of the first strategy that yields one -> (page_id, pre, strategy)."""
    ranked = None
    for i, s in enumerate(strategies):
        part = s.select("page_id", F.lit(i).alias("prio"), "pre", "strategy")
        ranked = part if ranked is None else ranked.unionByName(part)
    best = ranked.groupBy("page_id").agg(F.min(F.struct("prio", "pre", "strategy")).alias("b"))
    return best.select("page_id", F.col("b.pre").alias("pre"), F.col("b.strategy").alias("strategy"))


def block_html(blocks: DataFrame, nodes: DataFrame, pages: DataFrame, id_col: str = "page_id",
               html_col: str = "html", keep=()) -> DataFrame:
    """Outer HTML of each selected block: (block columns, block_html, the pages' columns in ``keep``)."""
    spans = blocks.join(nodes.select("page_id", "pre", "start_offset", "end_offset"), ["page_id", "pre"])
    pg = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("_html"),
                      *[F.col(k).alias(f"_keep_{k}") for k in keep])
    return spans.join(pg, "page_id").select(
        *[c for c in blocks.columns],
        F.col("_html").substr(F.col("start_offset") + 1, F.col("end_offset") - F.col("start_offset"))
        .alias("block_html"), *[F.col(f"_keep_{k}").alias(k) for k in keep])


def block_documents(blocks: DataFrame, nodes: DataFrame, pages: DataFrame, default_title: str = "Speiseplan",
                    id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Each chosen block as a page of its own -> (page_id, pre, strategy, title, doc).

    A block found by its heading carries the page's title, or ``default_title``
    where the page has none; one found by keywords is titled by the default
    and the page's address, ``<default> - <url>``.
    """
    both = block_html(blocks, nodes, pages, id_col, html_col, keep=(html_col, url_col))
    title = F.when(F.col("strategy") == "keyword", F.concat(F.lit(f"{default_title} - "), F.coalesce(F.col(url_col), F.lit("")))) \
        .otherwise(page_title(F.col(html_col), default_title))
    return both.select("page_id", "pre", "strategy", title.alias("title"), wrap_document(F.col("block_html"), title).alias("doc"))
