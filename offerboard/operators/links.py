"""Link and page-level operators (B2-B5, B7, B14, B16-B23) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerboard.functions import html as H
from offerboard.functions.text import ascii_fold, html_unescape, minify_ws, safe_name, starts_with_year, strip_ws


def extract_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                  keep=("url",)) -> DataFrame:
    """One row per anchor with an href: (page_id, pos, href, text) in document order.

    ``pos`` counts all anchors of the page. The href may be double-quoted,
    single-quoted or bare; an anchor without one is no link. The text is the
    anchor's content without markup.
    """
    keep = [c for c in keep if c in pages.columns]
    anchors = pages.select(id_col, *keep, F.posexplode(F.regexp_extract_all(
        F.col(html_col), F.lit(H.ANCHOR), 0)).alias("pos", "a"))
    start = F.regexp_extract("a", H.ANCHOR_START, 0)
    href = F.concat(*[F.regexp_extract(start, H.HREF, i) for i in (1, 2, 3)])     # one of the three groups matches
    content = F.regexp_extract("a", r"(?is)^<a\s[^>]*>(.*)</a\s*>$", 1)
    return anchors.filter(start.rlike(H.HREF)).select(
        id_col, *keep, F.col("pos").cast("bigint").alias("pos"), html_unescape(href).alias("href"),
        html_unescape(F.regexp_replace(content, H.TAG, "")).alias("text"))


def _any_contains(col: Column, needles) -> Column:
    cond = F.lit(False)
    for n in needles:
        cond = cond | col.contains(n)
    return cond


def filter_links_href(links: DataFrame, any_of, href: str = "href") -> DataFrame:
    """Keep links whose href contains any of the substrings (case-sensitive)."""
    return links.filter(_any_contains(F.col(href), any_of))


def filter_links_text(links: DataFrame, word: str, fold: bool = True, href_any_of=None,
                      text: str = "text", href: str = "href") -> DataFrame:
    """Keep links whose (ASCII-folded) text contains ``word``; optionally AND an href test."""
    t = ascii_fold(F.col(text)) if fold else F.col(text)
    cond = t.contains(word)
    if href_any_of:
        cond = cond & _any_contains(F.col(href), href_any_of)
    return links.filter(cond)


def site_base(url_col) -> Column:
    """``scheme://host`` of a URL."""
    u = F.col(url_col) if isinstance(url_col, str) else url_col
    return F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def absolutize(links: DataFrame, base, href: str = "href", out: str = "url") -> DataFrame:
    """Absolute hrefs are kept, relative ones get ``base`` in front (base: str or Column)."""
    b = F.lit(base) if isinstance(base, str) else base
    return links.withColumn(out, F.when(F.col(href).startswith("http"), F.col(href))
                            .otherwise(F.concat(b, F.col(href))))


def host_of(url_col) -> Column:
    u = F.col(url_col) if isinstance(url_col, str) else url_col
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))


def domain_filter(pages: DataFrame, domains, url: str = "url", id_col: str = "page_id") -> DataFrame:
    """Keep pages whose host is an allowed domain or a sub-domain of one.

    Each host is expanded into its dot suffixes (a.b.c -> a.b.c, b.c, c). A
    list passed by the caller becomes one literal array and the test is an
    ``arrays_overlap`` in the scan's codegen stage; an allow-list DataFrame of
    any size is matched by an equi semi-join on the suffix instead (the planner
    and AQE choose the join by bytes).
    """
    labels = F.split(host_of(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    if not isinstance(domains, DataFrame):
        allow = F.array(*[F.lit(d.lower()) for d in domains])
        return pages.filter(F.coalesce(F.arrays_overlap(suffixes, allow), F.lit(False)))
    allow = domains.select(F.lower(F.col(domains.columns[0])).alias("_domain")).distinct()
    keyed = pages.select(id_col, F.explode(suffixes).alias("_domain"))
    hits = keyed.join(allow, "_domain", "left_semi").select(id_col).distinct()
    return pages.join(hits, id_col, "left_semi")


def page_titles(pages: DataFrame, default: str = "Speiseplan", html: str = "html") -> DataFrame:
    return pages.withColumn("title", H.page_title(F.col(html), default))


def safe_names(pages: DataFrame, prefix: str, url: str = "url") -> DataFrame:
    """Artifact names for the raw and the cleaned copy of a page."""
    raw = safe_name(F.col(url), prefix)
    return pages.withColumn("raw_name", raw).withColumn("cleaned_name", F.concat(F.lit("cleaned_"), raw))


def page_meta(pages: DataFrame, prop: str = "article:modified_time", html: str = "html") -> DataFrame:
    """Meta value, its validity (starts with a year) and the parsed time (NULL when not a time)."""
    v = H.meta_property(F.col(html), prop)
    return (pages.withColumn("meta_value", v)
            .withColumn("meta_valid", starts_with_year(v))
            .withColumn("meta_ts", F.when(starts_with_year(v), F.coalesce(
                F.try_to_timestamp(v, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
                F.try_to_timestamp(v, F.lit("yyyy-MM-dd'T'HH:mm:ssX")),
                F.try_to_timestamp(v)))))


def page_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """script/style/comments removed, text nodes trimmed, blanks dropped, joined by newline."""
    return pages.withColumn(out, H.text_lines(F.col(html)))


def page_lines(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """B17 as rows: (page_id, pos, line); pos is the fragment index in the page."""
    frags = F.transform(F.split(H.strip_non_text(F.col(html)), H.TAG), lambda p: strip_ws(html_unescape(p)))
    parts = pages.select(id_col, F.posexplode(frags).alias("pos", "line"))
    return parts.filter(F.col("line") != "").select(id_col, F.col("pos").cast("bigint").alias("pos"), "line")


def clean_pages(pages: DataFrame, safe_attrs=tuple(H.SAFE_ATTRS), kill_tags=tuple(H.KILL_TAGS),
                html: str = "html", out: str = "clean_html", minify: bool = False) -> DataFrame:
    """B15 (+ B16 when ``minify``): attribute allow-list, kill-listed elements removed."""
    c = H.clean_html(F.col(html), safe_attrs, kill_tags)
    return pages.withColumn(out, minify_ws(c) if minify else c)


def minify_pages(pages: DataFrame, html: str = "html", out: str = "min_html") -> DataFrame:
    return pages.withColumn(out, minify_ws(F.col(html)))


def with_status(df: DataFrame, value: str, fallback: str, out: str = "result") -> DataFrame:
    """A failed step yields NULL and a status, never a failed job; fallback used instead."""
    return (df.withColumn("status", F.when(F.col(value).isNull(), F.lit("fallback")).otherwise(F.lit("ok")))
            .withColumn(out, F.coalesce(F.col(value), F.col(fallback))))


def expect_count(items: DataFrame, keys: DataFrame, key: str, op: str, n: int, fail: bool = False) -> DataFrame:
    """Count items per key and judge the count; every key of ``keys`` appears once.

    op is one of ``>=``, ``==``. Output: (key, n_items, accepted). A key with no
    items has n_items 0. Rejections are rows, not a stopped job; with
    ``fail=True`` a rejected key fails the job instead (``assert_true``).
    """
    counts = items.groupBy(key).agg(F.count(F.lit(1)).alias("n_items"))
    out = keys.select(key).join(counts, key, "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("bigint"))
    cond = {">=": F.col("n_items") >= n, "==": F.col("n_items") == n}[op]
    out = out.withColumn("accepted", cond)
    if fail:
        # inside a filter (keeps every row) so column pruning cannot drop the check
        out = out.filter(F.assert_true(F.col("accepted"), F.concat(
            F.lit(f"count {op} {n} failed for {key}="), F.col(key).cast("string"))).isNull())
    return out
