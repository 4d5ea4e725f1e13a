"""HTML expressions that work on the raw page text without a parser.

They cover what a regular expression can say reliably: titles, meta values,
anchors, removal of script/style/comment blocks, text lines and attribute
allow-lists. Structural questions (ancestors, n-th child) go through the node
table in ``offerboard.operators.nodes``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerboard.functions.text import html_unescape, strip_ws

NON_TEXT_BLOCKS = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
TAG = r"<[^>]*>"
ANCHOR = r"(?is)<a\s[^>]*>.*?</a\s*>"
ANCHOR_START = r"(?is)^<a\s[^>]*>"
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TITLE = r"(?is)<title[^>]*>([^<]*)</title>"

# Attribute allow-lists and removed elements of the two page
# cleaners.
SAFE_ATTRS = ["src", "alt", "href", "title"]
SAFE_ATTRS_WITH_SIZE = ["src", "alt", "href", "title", "width", "height"]
KILL_TAGS = ["object", "iframe"]

DOCUMENT_HEAD = "<!doctype html><html><head><title>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_non_text(html) -> Column:
    """Remove script and style elements and comments."""
    return F.regexp_replace(_c(html), NON_TEXT_BLOCKS, "")


def page_title(html, default: str | Column | None = None) -> Column:
    title = html_unescape(F.nullif(F.regexp_extract(_c(html), TITLE, 1), F.lit("")))
    if default is None:
        return title
    return F.coalesce(title, default if isinstance(default, Column) else F.lit(default))


def meta_property(html, prop: str) -> Column:
    """content of ``<meta property="prop" content="...">`` (either attribute order); '' if absent."""
    p = prop.replace(".", r"\.")
    first = rf'(?is)<meta\s[^>]*property\s*=\s*"{p}"[^>]*content\s*=\s*"([^"]*)"'
    second = rf'(?is)<meta\s[^>]*content\s*=\s*"([^"]*)"[^>]*property\s*=\s*"{p}"'
    return F.coalesce(F.nullif(F.regexp_extract(_c(html), first, 1), F.lit("")),
                      F.nullif(F.regexp_extract(_c(html), second, 1), F.lit("")), F.lit(""))


def text_fragments(html) -> Column:
    """ARRAY of trimmed, entity-decoded, non-empty text nodes in document order."""
    parts = F.split(strip_non_text(html), TAG)
    return F.filter(F.transform(parts, lambda p: strip_ws(html_unescape(p))), lambda p: p != "")


def text_lines(html) -> Column:
    return F.array_join(text_fragments(html), "\n")


def kill_elements(html, tags=tuple(KILL_TAGS)) -> Column:
    out = _c(html)
    for t in tags:
        out = F.regexp_replace(out, rf"(?is)<{t}\b[^>]*>.*?</{t}\s*>|<{t}\b[^>]*/?>", "")
    return out


def keep_attrs(html, safe=tuple(SAFE_ATTRS)) -> Column:
    """Rewrite every start tag keeping only allow-listed attributes.

    The page is cut at ``<``; the head of each piece up to the first ``>`` is a
    tag, its name-value pairs are filtered against the allow-list and the tag
    is rebuilt. Pure higher-order functions, so it stays JVM-side.
    """
    pieces = F.split(_c(html), "<")
    allowed = F.array(*[F.lit(a) for a in safe])

    def rebuild(p: Column) -> Column:
        is_start = p.rlike(r"^[A-Za-z][A-Za-z0-9]*[\s/>]")
        name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*)", 1)
        head = F.regexp_extract(p, r"^[^>]*", 0)
        rest = p.substr(F.length(head) + 1, F.lit(1 << 30))
        attrs = F.regexp_extract_all(head, F.lit(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)\s*=\s*("[^"]*"|'[^']*')"""), 0)
        kept = F.filter(attrs, lambda a: F.array_contains(
            allowed, F.lower(F.regexp_extract(a, r"^([A-Za-z_:][-A-Za-z0-9_:.]*)", 1))))
        self_close = F.when(head.rlike(r"/\s*$"), F.lit(" /")).otherwise(F.lit(""))
        attr_text = F.when(F.size(kept) > 0, F.concat(F.lit(" "), F.array_join(kept, " "))).otherwise(F.lit(""))
        return F.when(is_start, F.concat(name, attr_text, self_close, rest)).otherwise(p)

    return F.array_join(F.transform(pieces, rebuild), "<")


SCRIPT_AND_COMMENTS = r"(?is)<script\b[^>]*>.*?</script\s*>|<!--.*?-->"
# link and meta elements are dropped; javascript: URLs are blanked
LINK_META = r"(?is)<(?:link|meta)\b[^>]*>"
JS_URL = r"""(?i)((?:href|src)\s*=\s*")\s*javascript:[^"]*(")"""


def clean_html(html, safe_attrs=tuple(SAFE_ATTRS), kill_tags=tuple(KILL_TAGS)) -> Column:
    """Page cleaner: scripts, comments, link/meta elements and kill-listed elements removed,
    ``javascript:`` URLs blanked, only allow-listed attributes kept; style elements stay."""
    c = F.regexp_replace(F.regexp_replace(_c(html), SCRIPT_AND_COMMENTS, ""), LINK_META, "")
    c = F.regexp_replace(kill_elements(c, kill_tags), JS_URL, "$1$2")
    return keep_attrs(c, safe_attrs)


def wrap_document(block, title) -> Column:
    """A block inside a minimal page whose title is ``title``."""
    return F.concat(F.lit(DOCUMENT_HEAD), _c(title) if not isinstance(title, str) else F.lit(title),
                    F.lit("</title></head><body>"), _c(block), F.lit("</body></html>"))
