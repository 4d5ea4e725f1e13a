"""B15 on the node table: a page's HTML written anew from its elements, by allow-lists of elements and attributes.

The tokenizer has decided what is an element; text that only looks like a tag
stays text, and no pattern runs over the HTML. Every element is killed (with
all in it), dropped (its content stays) or kept with its safe attributes.
Comments, declarations and processing instructions are no elements, so they
are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerboard.operators.nodes import VOID_TAGS

# What a cleaner with all its usual switches on does to an element.
KILLED = ("script", "link", "meta", "applet", "frame", "frameset", "noframes", "button", "input", "select", "textarea",
          "object", "iframe")
DROPPED = ("html", "head", "title", "body", "embed", "layer", "param", "form", "blink", "marquee")
KNOWN = ("a", "abbr", "acronym", "address", "area", "article", "aside", "audio", "b", "base", "bdi", "bdo", "big", "blockquote", "br",
         "caption", "center", "cite", "code", "col", "colgroup", "data", "dd", "del", "details", "dfn", "dir", "div", "dl", "dt", "em",
         "fieldset", "figcaption", "figure", "font", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "i", "img", "ins",
         "kbd", "label", "legend", "li", "main", "map", "mark", "menu", "nav", "ol", "optgroup", "option", "p", "picture", "pre", "q",
         "s", "samp", "section", "small", "source", "span", "strike", "strong", "style", "sub", "summary", "sup", "table", "tbody", "td",
         "tfoot", "th", "thead", "time", "tr", "track", "tt", "u", "ul", "var", "video", "wbr")
SAFE = ("src", "alt", "href", "title")
URLS = ("src", "href", "action", "background", "cite", "poster")
RAW_TEXT = ("style",)

COLUMNS = ("pre", "post", "depth", "tag", "attrs", "before_start", "before_end", "after_page")


def escaped(text) -> Column:
    """Text as HTML."""
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def safe_url(value: Column) -> Column:
    """Whether an address runs no script; blanks and control characters in it hide none."""
    bare = F.lower(F.regexp_replace(value, r"[\x00-\x20]+", ""))
    return ~bare.rlike(r"^(javascript|vbscript|jscript|livescript|mocha|about|data):") | bare.rlike(r"^data:image/(png|gif|jpe?g|webp);")


def start_tag(tag: Column, attrs: Column, safe=SAFE) -> Column:
    """The start tag with the safe attributes; an unsafe address becomes empty."""
    kept = F.map_filter(attrs, lambda k, _: k.isin(*safe)) if safe else F.map_filter(attrs, lambda k, _: F.lit(False))
    value = lambda e: F.when(e["key"].isin(*URLS) & ~safe_url(e["value"]), F.lit("")).otherwise(e["value"])
    one = lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'), F.replace(escaped(value(e)), F.lit('"'), F.lit("&quot;")), F.lit('"'))
    return F.concat(F.lit("<"), tag, F.array_join(F.transform(F.map_entries(kept), one), ""), F.lit(">"))


def clean_nodes(nodes: DataFrame, kill=KILLED, drop=DROPPED, known=KNOWN, safe=SAFE) -> DataFrame:
    """(page_id, clean_html) of every page with an element, from its nodes (``COLUMNS``).

    ``known=None`` keeps elements of any name that is neither killed nor
    dropped. An element is two pieces, its start and its end, each with the
    text before it. What lies in a killed element is left out: of the killed
    ones opened before, one closes after it. One row an element is shuffled
    and the nodes are read once, so a page is parsed once; linear in the page.
    """
    opens = 2 * F.col("pre") - F.col("depth")
    closes = 2 * F.col("post") + F.col("depth") + 1
    killed = F.col("tag").isin(*kill)
    kept = ~killed & ~F.col("tag").isin(*drop)
    if known is not None:
        kept = kept & F.col("tag").isin(*known)
    bare = F.concat(F.lit("<"), F.col("tag"), F.lit(">"))
    start = F.when(F.size("attrs") > 0, start_tag(F.col("tag"), F.col("attrs"), safe)).otherwise(bare)
    end = F.when(F.col("tag").isin(*sorted(VOID_TAGS)), F.lit("")).otherwise(F.concat(F.lit("</"), F.col("tag"), F.lit(">")))
    inner = F.when(F.col("tag").isin(*RAW_TEXT), F.col("before_end")).otherwise(escaped(F.col("before_end")))
    written = nodes.select(
        "page_id", "pre", "post", opens.alias("opens"), closes.alias("closes"), killed.alias("_killed"),
        F.concat(escaped(F.col("before_start")), F.when(kept, start).otherwise(F.lit(""))).alias("head"),
        # what is in a killed element goes with it
        F.when(killed, F.lit("")).otherwise(F.concat(inner, F.when(kept, end).otherwise(F.lit("")))).alias("tail"),
        F.when(F.col("pre") == 0, escaped(F.col("after_page"))).alias("rest"))
    # in the order of the elements; a page that comes twice holds each of them twice, one behind the other
    before = Window.partitionBy("page_id").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    hidden = F.coalesce(F.max(F.when(F.col("_killed"), F.col("post"))).over(before) >= F.col("post"), F.lit(False))
    piece = lambda at, text, shown: F.when(shown & (F.col(text) != ""), F.struct(at.alias("at"), F.col(text).alias("piece")))
    shown = F.array_compact(F.array(piece(F.col("opens"), "head", ~F.col("_in")), piece(F.col("closes"), "tail", ~F.col("_in")),
                                    piece(F.lit(2**31 - 1), "rest", F.lit(True))))
    pieces = written.withColumn("_in", hidden).select("page_id", (F.col("pre") == 0).alias("_page"), shown.alias("_p")) \
        .filter(F.col("_page") | (F.size("_p") > 0))
    whole = pieces.groupBy("page_id").agg(F.count(F.when(F.col("_page"), 1)).cast("int").alias("_n"),
                                          F.array_sort(F.flatten(F.collect_list("_p"))).alias("_p"))
    text = F.array_join(F.transform("_p", lambda p: p["piece"]), "")
    return whole.select("page_id", text.alias("clean_html"), F.explode(F.array_repeat(F.lit(0), F.col("_n")))).select("page_id", "clean_html")
