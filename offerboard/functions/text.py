"""String expressions."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# XPath translate() folding used by the link and heading tests.
# Only the 26 ASCII capitals are folded, so umlauts keep their case.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

# Named HTML entities beyond the standard library's table of
# character names, or decoded differently from it.
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&euro;", "€"),
    ("&amp;", "&"),
]

# Leading/trailing white space including the no-break space; Spark's trim()
# only strips ASCII spaces. btrim with a character set avoids a regex per value.
EDGE_WS_CHARS = " \t\n\x0b\f\r\u00a0"

# Trailing allergen / additive code list such as "a,g.i", "ag", "aw,i,j,11",
# "a.aWc239": one or two allergen letters (a to n), or a token holding digits
# or separators, at the very end of a description.
FOOTNOTE_TAIL = (
    r"\s+(?:[a-n][a-nwA-Z]?|[a-z][a-zA-Z0-9]*(?:[,.][a-zA-Z0-9]+)+"
    r"|[a-z][a-zA-Z]{0,3}[0-9][a-zA-Z0-9]*|[0-9]+(?:,[0-9a-z]+)+)$"
)
# Endings of that form which are words or prices, so they stay.
NO_FOOTNOTE = r"\s(?:ab|am|an|da|im|in|ja|be|he|if|me|[0-9]+,[0-9]{2})$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ascii_fold(col) -> Column:
    return F.translate(_c(col), ASCII_UPPER, ASCII_LOWER)


def strip_ws(col) -> Column:
    return F.btrim(_c(col), F.lit(EDGE_WS_CHARS))


def normalize_space(col) -> Column:
    """XPath normalize-space(): trim and collapse runs of XML white space."""
    return F.trim(F.regexp_replace(_c(col), r"[ \t\r\n]+", " "))


def minify_ws(col) -> Column:
    return F.regexp_replace(_c(col), r"[ \t\r\n\f]+", " ")


def html_unescape(col) -> Column:
    """Character references decoded once: ``&name;``, ``&#228;`` and ``&#xE4;``.

    The text is cut at ``&``; a piece that opens with a known reference has it
    replaced. Names come from the standard library's table as one literal map;
    unknown names and invalid code points stay as they are.
    """
    c = _c(col)
    # one literal, folded to a map by the optimizer; a literal an entry would be 500 calls to the JVM at each use
    names = F.from_json(F.lit(json.dumps(_entity_names())), "map<string,string>")

    def decoded(piece: Column) -> Column:
        ref = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,30});", 1)
        digits = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10)).otherwise(F.substring(ref, 2, 7))
        point = digits.try_cast("int")
        valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        number = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
        ch = F.when(ref == "", F.lit(None)).when(ref.startswith("#"), number).otherwise(F.try_element_at(names, ref))
        rest = piece.substr(F.length(ref) + 2, F.length(piece))
        return F.coalesce(F.concat(ch, rest), F.concat(F.lit("&"), piece))

    pieces = F.split(c, "&", -1)
    whole = F.concat(F.element_at(pieces, 1),
                     F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), decoded), ""))
    return F.when(c.contains("&"), whole).otherwise(c)


def _entity_names() -> dict[str, str]:
    names = {n: chr(p) for n, p in name2codepoint.items()}
    names.update({e[1:-1]: ch for e, ch in HTML_ENTITIES if not e.startswith("&#")})
    return names


def clean_desc(col) -> Column:
    """Line breaks, tabs and control characters become one space; trimmed."""
    return strip_ws(F.regexp_replace(_c(col), r"[\s\x{A0}\p{Cntrl}]+", " "))


def strip_footnotes(col) -> Column:
    """A trailing code list goes; a trailing word or price of the same form stays."""
    c = _c(col)
    return F.when(c.rlike(NO_FOOTNOTE), c).otherwise(F.regexp_replace(c, FOOTNOTE_TAIL, ""))


def safe_name(url_col, prefix: str = "", suffix: str = ".html") -> Column:
    """``://`` and ``/`` become ``_``; prefix and suffix added."""
    body = F.replace(F.replace(_c(url_col), F.lit("://"), F.lit("_")), F.lit("/"), F.lit("_"))
    return F.concat(F.lit(prefix), body, F.lit(suffix))


def starts_with_year(col) -> Column:
    return F.coalesce(_c(col).rlike(r"^[0-9]{4}"), F.lit(False))


def word_count(col) -> Column:
    return F.size(F.filter(F.split(_c(col), r"[ \t\r\n]+"), lambda w: w != ""))


def run_order(col) -> Column:
    """Sort key of a run label: numbers in it compare as numbers (``r2`` before ``r10``); NULL comes first."""
    padded = F.regexp_replace(F.coalesce(_c(col), F.lit("")), "([0-9]+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, "[0-9]*([0-9]{20})", "$1")
