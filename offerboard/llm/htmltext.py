"""Main text of web pages from parser events and text-to-tag ratios (operator 6).

The standard library's streaming parser turns a page into lines: one for each
block of text. A line's ratio is its text length over the tags in it. Ratios
are smoothed with a Gaussian along the page, the smoothed values are split by
two-means into a low and a high cluster, and the lines of the high cluster mark
content. The region is the smallest container that holds all marked lines, or those
of its parts that hold some, if it has no marked line of its own; elements whose role is known from their element name (navigation, footers,
forms and the like) never belong to it. A class, id or role that names such a role discards an
element too, unless it holds an article, the main element or most of the page's marked text (and, if the page has
articles elsewhere, far more than they).
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

# HTML element names.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas audio video map datalist".split())
FURNITURE = frozenset("nav header footer aside form button select textarea input label fieldset menu dialog".split())
BLOCKS = frozenset("""address article blockquote body br caption center dd details div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
    thead tr ul aside dialog noscript""".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
REGIONS = frozenset("html body main article section div center table td".split())
SPLIT = frozenset("html body section div center".split())      # regions that may give up parts without a marked line
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Class, id and role values that name page furniture: whole tokens of these words, alone or joined with words of place.
BAD_WORD = (r"nav\w*|menu\w*|header|footer|sidebar\w*|side|aside|ads?|advert\w*|promo\w*|sponsor\w*|banner|"
            r"cookie\w*|consent|gdpr|notice|popup|modal|newsletter|subscribe|signup|login|search|form|share|sharing|social|"
            r"related|recommend\w*|breadcrumbs?|pagination|pager|comments?|respond|replies|disqus|widget\w*|toolbar|"
            r"contentinfo|navigation|complementary|alert|hidden|skip\w*")
PLACE = r"site|main|page|global|top|bottom|left|right|upper|lower|primary|secondary|box|bar|area|block|list|links|wrap|wrapper|inner"
BAD_NAME = re.compile(rf"(?:^|\s)(?:(?:{PLACE})[_-]+)*(?:{BAD_WORD})(?:[_-]+(?:{BAD_WORD}|{PLACE}))*(?=$|\s)", re.I)
HALF = 0.5      # share of the page's marked text that a name alone does not discard,
TIMES = 4       # and its least size in texts of the page's articles
APART = float(np.log(2))    # clusters whose mean ratios are within a factor of two are one
SPACE = re.compile(r"\s+")
LONG_REFERENCE = re.compile(r"&#([0-9]{4000,});?")     # more digits than int() takes


class PageLines(HTMLParser):
    """Collects (text, tags, container, furniture, suspect, article, heading) lines from parser events.

    Text between two block boundaries is one line; ``container`` numbers the
    innermost open block container, ``parent`` gives each container's own.
    ``suspect`` numbers the innermost open element whose class, id or role
    names furniture (0: none), ``outer`` gives each suspect's own; ``spared``
    are those that hold an article or the main element. ``article`` tells
    lines within these, ``heading`` those of a heading element.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.parts, self.tags = [], [], 0
        self.open: list[tuple[str, bool, bool, int, int]] = []  # name, silent, furniture, container and suspect number
        self.silent = self.furniture = 0
        self.parent, self.names = [0], [""]                 # of every container number
        self.suspect, self.outer, self.spared = 0, [0], set()
        self.articles = 0

    def parse_marked_section(self, i, report=1):
        # "<![foo[x]]>" outside of foreign content is a comment up to the next ">"
        return self.parse_bogus_comment(i)

    def boundary(self):
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((text, self.tags, self.holder(), self.furniture > 0, self.suspect, self.articles > 0,
                                   any(o[0] in HEADINGS for o in self.open[-4:])))
                self.tags = 0
            self.parts = []

    def holder(self) -> int:
        return next((number for _, _, _, number, _ in reversed(self.open) if number), 0)

    def push(self, name, silent, furniture, number, suspect):
        if suspect:
            self.outer.append(self.suspect)
            self.suspect = suspect = len(self.outer) - 1
        self.open.append((name, silent, furniture, number, suspect))
        self.silent += silent
        self.furniture += furniture
        self.articles += name in ("article", "main")

    def pop(self):
        name, silent, furniture, _, suspect = self.open.pop()
        self.silent -= silent
        self.furniture -= furniture
        self.articles -= name in ("article", "main")
        if suspect:
            self.suspect = self.outer[suspect]

    def handle_starttag(self, name, attrs):
        block = name in BLOCKS
        if block:
            self.boundary()
        self.tags += 1
        if name in VOID:
            return
        if name in ("body", "main", "article") or block and self.silent:
            # what is still open of the page's head or navigation was never closed
            ends = ("head", "nav", "header", "title") if name != "article" else ("head", "nav", "title")
            at = next((i for i, o in enumerate(self.open) if o[0] in ends), None)
            if at is not None:
                while len(self.open) > at:
                    self.pop()
        if block and self.open:
            # an open paragraph ends at the next block, list items and cells at the next of their kind
            for i in range(len(self.open) - 1, -1, -1):
                o = self.open[i][0]
                if o == "p" or o == name and name in ("li", "td", "th", "tr", "dd", "dt", "option"):
                    while len(self.open) > i:
                        self.pop()
                    break
                if o in BLOCKS:
                    break
        furniture, suspect = name in FURNITURE, False
        if not furniture and attrs and name not in ("html", "body", "main"):
            for key, value in attrs:
                if value is None:
                    furniture |= key == "hidden"
                elif key == "aria-hidden" and value == "true":
                    furniture = True
                elif key in ("class", "id", "role") and name != "article" and BAD_NAME.search(value):
                    suspect = True
        if name in ("article", "main") and not self.furniture:
            at = self.suspect
            while at and at not in self.spared:
                self.spared.add(at)
                at = self.outer[at]
        number = 0
        if block and name not in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "th", "dd", "dt"):
            number = len(self.parent)
            self.parent.append(self.holder())
            self.names.append(name)
        self.push(name, name in SILENT, furniture, number, suspect)

    def handle_startendtag(self, name, attrs):
        if name in BLOCKS:
            self.boundary()
        self.tags += 1

    def handle_endtag(self, name):
        if name in BLOCKS:
            self.boundary()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name:
                while len(self.open) > i:
                    self.pop()
                return

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)


def smooth(ratio: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing along the lines; the ends are mirrored."""
    reach = max(1, int(np.ceil(3 * sigma)))
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratio, reach, "symmetric" if len(ratio) >= reach else "edge"), w / w.sum(), "valid")


def two_means(x: np.ndarray) -> float:
    """The threshold of the high cluster: the middle of two cluster means (minus infinity if these are APART or less)."""
    low, high = float(x.min()), float(x.max())
    if high - low <= APART:
        return -np.inf
    cut = (low + high) / 2
    while True:
        up = x > cut
        means = x[up].mean(), x[~up].mean()
        new = sum(means) / 2
        if abs(new - cut) < 1e-9 * max(1.0, high):
            return cut if means[0] - means[1] > APART else -np.inf
        cut = new


def mark(lines: list[tuple], sigma: float) -> np.ndarray:
    """Lines that mark content: their smoothed ratio, or their own beside short lines, is in the high cluster."""
    # long lines count by logarithm: one long paragraph must not push the others into the low cluster
    ratio = np.log1p(np.array([len(x[0]) / max(1, x[1]) for x in lines]))
    smoothed = smooth(ratio, sigma)
    return np.maximum(smoothed, ratio) > two_means(smoothed)


def outside(parser: PageLines, lines: list[tuple], sigma: float) -> list[tuple]:
    """The lines in no element that its name discards."""
    if not any(x[4] for x in lines):
        return lines
    weight = [0] * len(parser.outer)
    for (text, _, _, _, suspect, *_), up in zip(lines, mark(lines, sigma)):
        weight[suspect] += len(text) if up else 0
    articles = sum(len(x[0]) for x in lines if x[5])
    for k in range(len(weight) - 1, 0, -1):
        weight[parser.outer[k]] += weight[k]
    out = [False] * len(weight)
    for k in range(1, len(weight)):
        out[k] = out[parser.outer[k]] or k not in parser.spared and weight[k] <= max(HALF * weight[0], TIMES * articles)
    return [x for x in lines if not out[x[4]]]


def region(parser: PageLines, lines: list[tuple], marked: np.ndarray) -> list[bool]:
    """The lines of the region: every marked one, and the short ones (headings, list items) beside them."""
    size = len(parser.parent)
    own, own_lines = [0] * size, [0] * size
    for x, up in zip(lines, marked):
        own[x[2]] += bool(up)
        own_lines[x[2]] += 1
    below, inside = own[:], [[] for _ in range(size)]
    for k in range(size - 1, 0, -1):
        below[parser.parent[k]] += below[k]
        if below[k]:
            inside[parser.parent[k]].append(k)
    whole, direct, todo = [False] * size, [False] * size, [(0, 0)]
    while todo:
        top, best = todo.pop()
        at = top
        # down to the smallest container of the marked lines; an article is never cut, nor a table, but for
        # a cell that lays out a part of the page
        while parser.names[at] not in ("article", "main") and not own[at] and len(inside[at]) == 1:
            at = inside[at][0]
            if parser.names[at] in REGIONS and (parser.names[at] != "td" or own_lines[at] != 1):
                best = at
        if best == at and not own[at] and (not at or parser.names[at] in SPLIT):
            # headings and other short lines of its own stay, parts without a marked line do not
            direct[at] = True
            todo += [(k, k) for k in inside[at]]
        else:
            whole[best] = True
    for k in range(1, size):
        whole[k] = whole[k] or whole[parser.parent[k]]
    kept = [whole[x[2]] or direct[x[2]] for x in lines]
    # a heading before the region belongs to it
    for i in range(len(lines) - 2, -1, -1):
        kept[i] = kept[i] or kept[i + 1] and lines[i][6]
    return kept


def main_text(page: str, sigma: float = 1.0) -> str:
    """The content blocks of a page in order, one a line (empty if there are none)."""
    parser = PageLines()
    parser.feed(LONG_REFERENCE.sub(lambda m: f"&#{m[1].lstrip('0')[:8] or 0};", page))
    parser.close()
    parser.boundary()
    lines = outside(parser, [x for x in parser.lines if not x[3]], sigma)
    if not lines:
        return ""
    marked = mark(lines, sigma)
    article = np.array([x[5] for x in lines])
    if not (marked & article).any():
        marked |= article       # a short article beside long text
    kept = region(parser, lines, marked)
    return "\n".join(x[0] for x, k in zip(lines, kept) if k)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",),
                 sigma: float = 1.0) -> DataFrame:
    """(id, kept columns, text, n_chars) for every page; no shuffle.

    Null and empty pages, and pages without content, give an empty text.
    Character references are decoded, white space inside a block becomes one
    blank. Repeated rows give repeated results, an empty table none; columns
    not named are not read. Whole pages, however long, one at a time.
    """
    names = [id_col, *keep]

    def work(batches):
        for b in batches:
            text = [main_text(h, sigma) if h else "" for h in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(names))] + [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=[f"c{i}" for i in range(len(names))] + ["text", "n_chars"])

    kinds = [pages.schema[n].dataType.simpleString() for n in names]
    out = (pages.select(*[F.col(n).alias(f"c{i}") for i, n in enumerate(names)], F.col(html_col).alias("html"))
           .mapInArrow(work, ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)) + ", text string, n_chars long"))
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], "text", "n_chars")
