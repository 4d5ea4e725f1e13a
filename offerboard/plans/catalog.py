"""Registered queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``. The
oracle is written independently in DuckDB's dialect (RE2 regexes, list
lambdas, UNPIVOT, window functions) over the same parquet tables; column names
and types match the Spark result. Node-table queries whose answers depend on
the tree structure (parents, ancestors, containers) have no oracle, since no
SQL engine builds that tree out of HTML; the tests check them against a
brute-force tree walk. Element counts and document order of the node table do
have oracles (``node_tag_counts``, ``node_order``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerboard.functions import html as H
from offerboard.functions.dates import week_label, week_monday
from offerboard.functions.prices import PRICE_TYPE, format_price, split_desc_price
from offerboard.functions.text import clean_desc, strip_footnotes, word_count
from offerboard.operators import board as B
from offerboard.operators import incremental as E
from offerboard.operators import links as L
from offerboard.operators import menus as C
from offerboard.operators import nodes as N
from offerboard.operators import quality as Q
from offerboard.plans import views as V
from offerboard.session import literal_table, materialize, shared_dir
from offerboard.sources import readers as R
from offerboard.sources import sinks as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL pieces
# every reference that the driver's pages hold; &amp; last, so "&amp;lt;" gives "&lt;"
_SQL_ENTITIES = [("&nbsp;", "\u00a0"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                 ("&copy;", "©"), ("&middot;", "·"), ("&euro;", "€"), ("&amp;", "&")]


def _unescape(x: str) -> str:
    for ent, ch in _SQL_ENTITIES:
        x = f"replace({x}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return x


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')"


def _iso(d: str) -> str:
    return f"(CAST(isoyear({d}) AS VARCHAR) || '-W' || lpad(CAST(week({d}) AS VARCHAR), 2, '0'))"


def _board_week(d: str) -> str:
    return f"(CAST(year(date_trunc('week', {d})) AS VARCHAR) || '-W' || lpad(CAST(week({d}) AS VARCHAR), 2, '0'))"


def _status(raw: str) -> str:
    p = f"TRY_CAST(nullif(trim({raw}), '') AS DECIMAL(10,2))"
    return (f"CASE WHEN trim({raw}) IS NULL OR trim({raw}) = '' THEN 'missing' WHEN {p} IS NULL THEN 'invalid' "
            f"WHEN {p} = 0 THEN 'zero' ELSE 'ok' END")


_D = "CAST(ts AS DATE)"
OFFERS_CTE = f"""
offers AS (
  SELECT event_type AS location, {_iso(_D)} AS file_week,
         CASE WHEN event_type = '{V.WEEK_LOCATION}' THEN 'week' ELSE 'day' END AS key_kind,
         CASE WHEN event_type = '{V.WEEK_LOCATION}' THEN {_iso(_D)} ELSE strftime({_D}, '%Y-%m-%d') END AS offer_key,
         event_id AS pos, props AS "desc", CAST(value AS VARCHAR) AS price_raw,
         TRY_CAST(nullif(trim(CAST(value AS VARCHAR)), '') AS DECIMAL(10,2)) AS price,
         {_status('CAST(value AS VARCHAR)')} AS price_status
  FROM events)"""
LOCATIONS_CTE = """
locs AS (
  SELECT DISTINCT event_type AS location FROM events),
locations AS (
  SELECT location, upper(location) AS name, 'https://' || location || '.example.org/' AS link,
         CASE WHEN location = 'error' THEN []::VARCHAR[] ELSE ['open ' || location, 'card payment'] END AS details
  FROM locs)"""
_BD = f"DATE '{V.BOARD_DATE}'"
SELECTED_CTE = f"""
sel AS (
  SELECT *, CASE WHEN offer_key = '{V.BOARD_DATE}' THEN 'day' ELSE 'week' END AS section
  FROM offers WHERE offer_key IN ('{V.BOARD_DATE}', {_board_week(_BD)}) AND pos IS NOT NULL)"""

LINKS_CTE = f"""
arr AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*>.*?</a\\s*>') AS a FROM pages),
anchors AS (SELECT page_id, url, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS a FROM arr),
links AS (
  SELECT page_id, url, CAST(pos AS BIGINT) AS pos,
         {_unescape("regexp_extract(a, '(?is)\\shref\\s*=\\s*\"([^\"]*)\"', 1)")} AS href,
         {_unescape("regexp_replace(a, '<[^>]*>', '', 'g')")} AS text
  FROM anchors WHERE regexp_matches(a, '(?is)^<a\\s[^>]*href\\s*='))"""
_SITE_BASE = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"
_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1))"
_NON_TEXT = f"regexp_replace(html, '{H.NON_TEXT_BLOCKS}', '', 'g')"


# ---------------------------------------------------------------- A / D: offers and board
@register("offers", f"WITH {OFFERS_CTE} SELECT location, file_week, key_kind, offer_key, pos, \"desc\", price, price_status FROM offers")
def q_offers(spark, sf):
    """A1 + F1 on the driver view: long offer rows with normalised prices."""
    return V.offers(spark, sf).select("location", "file_week", "key_kind", "offer_key", "pos", "desc", "price",
                                      "price_status")


@register("day_offers", f"WITH {OFFERS_CTE} SELECT location, pos, \"desc\", price FROM offers WHERE offer_key = '{V.BOARD_DATE}'")
def q_day_offers(spark, sf):
    """D3."""
    return B.day_offers(V.board_offers(spark, sf), V.BOARD_DATE).select("location", "pos", "desc", "price")


@register("week_offers", f"WITH {OFFERS_CTE} SELECT location, pos, \"desc\", price FROM offers WHERE offer_key = {_board_week(_BD)}")
def q_week_offers(spark, sf):
    """D4 (board-style week label, as the board computes it)."""
    return B.week_offers(V.board_offers(spark, sf), V.BOARD_DATE, "board").select("location", "pos", "desc", "price")


_NEW_YEAR = "2024-12-30"


@register("week_offers_new_year", f"WITH {OFFERS_CTE} SELECT location, offer_key, pos, \"desc\", price FROM offers "
                                  f"WHERE offer_key = {_board_week(f"DATE '{_NEW_YEAR}'")}")
def q_week_offers_new_year(spark, sf):
    """D4 on a date whose board label names the first week of the year that ends."""
    return B.week_offers(V.board_offers(spark, sf, _NEW_YEAR), _NEW_YEAR, "board") \
        .select("location", "offer_key", "pos", "desc", "price")


@register("board_summary", f"""
WITH {OFFERS_CTE}, {LOCATIONS_CTE}, {SELECTED_CTE},
counts AS (SELECT location, count(*) FILTER (WHERE section = 'day') AS n_day,
                  count(*) FILTER (WHERE section = 'week') AS n_week FROM sel GROUP BY location)
SELECT l.location, l.name, l.link,
       CASE WHEN len(l.details) > 0 THEN array_to_string(l.details, ', ') END AS details_label,
       CAST(coalesce(c.n_day, 0) AS BIGINT) AS n_day, CAST(coalesce(c.n_week, 0) AS BIGINT) AS n_week,
       coalesce(c.n_day, 0) > 0 OR coalesce(c.n_week, 0) > 0 AS has_offers
FROM locations l LEFT JOIN counts c USING (location)""")
def q_board_summary(spark, sf):
    """Every location, its day/week counts, details label and has_offers."""
    return B.board_summary(V.board_offers(spark, sf), V.locations(spark, sf), V.BOARD_DATE)


@register("board_rows", f"""
WITH {OFFERS_CTE}, {SELECTED_CTE},
both_kinds AS (SELECT location FROM sel GROUP BY location
               HAVING count(*) FILTER (WHERE section = 'day') > 0 AND count(*) FILTER (WHERE section = 'week') > 0)
SELECT location, CASE WHEN section = 'day' THEN 0 ELSE 1 END AS section_rank, 1 AS row_rank,
       CAST(pos AS BIGINT) AS pos, 'meal' AS row_kind, "desc" AS text, price FROM sel
UNION ALL SELECT location, 0, 0, NULL, 'label', '{B.DAY_LABEL}', NULL FROM both_kinds
UNION ALL SELECT location, 1, 0, NULL, 'label', '{B.WEEK_LABEL}', NULL FROM both_kinds""")
def q_board_rows(spark, sf):
    """D8 + D10: display rows with section labels."""
    return B.board_rows(V.board_offers(spark, sf), V.BOARD_DATE)


@register("week_labels", f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, {_board_week('CAST(o_orderdate AS DATE)')} AS board_week,
       {_iso('CAST(o_orderdate AS DATE)')} AS iso_week FROM orders""")
def q_week_labels(spark, sf):
    """D2 both styles."""
    d = V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select("d", week_label("d", "board").alias("board_week"), week_label("d", "iso").alias("iso_week"))


@register("nested_offers", f"""
WITH {OFFERS_CTE}
SELECT location, offer_key, CAST(floor(pos / 1000) AS BIGINT) AS part,
       CAST(row_number() OVER (PARTITION BY location, offer_key, floor(pos / 1000) ORDER BY pos) - 1 AS BIGINT) AS idx,
       "desc", price
FROM offers""")
def q_nested_offers(spark, sf):
    """C20/A5: ordered meal lists per (location, key), in parts of <= 1000, exploded back to rows."""
    nested = C.nest_offers(V.offers(spark, sf), keys=("location", "offer_key"), max_items=1000)
    return nested.select("location", "offer_key", "part", F.posexplode("meals").alias("idx", "m")) \
        .select("location", "offer_key", "part", F.col("idx").cast("bigint").alias("idx"),
                F.col("m.desc").alias("desc"), F.col("m.price").alias("price"))


@register("stored_day_offers", f"WITH {OFFERS_CTE} SELECT location, pos, \"desc\", price FROM offers WHERE offer_key = '{V.BOARD_DATE}'")
def q_stored_day_offers(spark, sf):
    """A4 then D3: write the offers store partitioned by (location, file_week), read back pruned."""
    path = shared_dir(spark, "offers-store")
    S.write_offers(V.offers(spark, sf), path)
    stored = spark.read.parquet(path)
    wk = week_label(F.to_date(F.lit(V.BOARD_DATE)), "iso")
    return B.day_offers(stored.filter(F.col("file_week") == wk), V.BOARD_DATE).select("location", "pos", "desc", "price")


# ---------------------------------------------------------------- B: pages
@register("links", f"WITH {LINKS_CTE} SELECT page_id, pos, href, text FROM links")
def q_links(spark, sf):
    """B3."""
    return L.extract_links(V.table(spark, sf, "pages"), keep=()).select("page_id", "pos", "href", "text")


@register("links_by_href", f"WITH {LINKS_CTE} SELECT page_id, pos, href FROM links WHERE contains(href, '/th') OR contains(href, 'ion')")
def q_links_by_href(spark, sf):
    """Href contains any of the substrings, case-sensitive."""
    return L.filter_links_href(L.extract_links(V.table(spark, sf, "pages"), keep=()), ["/th", "ion"]) \
        .select("page_id", "pos", "href")


@register("links_by_text", f"""WITH {LINKS_CTE} SELECT page_id, pos, href, text FROM links
WHERE contains(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'the') AND contains(href, '/')""")
def q_links_by_text(spark, sf):
    """ASCII-folded link text holds a word, AND an href test."""
    return L.filter_links_text(L.extract_links(V.table(spark, sf, "pages"), keep=()), "the", href_any_of=["/"]) \
        .select("page_id", "pos", "href", "text")


@register("absolute_links", f"""WITH {LINKS_CTE} SELECT page_id, pos,
CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links""")
def q_absolute_links(spark, sf):
    """B7 with each page's scheme://host as base."""
    links = L.extract_links(V.table(spark, sf, "pages"))
    return L.absolutize(links, L.site_base("url")).select("page_id", "pos", "url")


_DOMAINS = ["example.org", "blog.tiontion.example.com"]


@register("domain_pages", f"""SELECT page_id, url FROM pages WHERE
{' OR '.join(f"{_HOST} = '{d}' OR ends_with({_HOST}, '.{d}')" for d in _DOMAINS)}""")
def q_domain_pages(spark, sf):
    """B2: pages on an allowed domain or its sub-domains."""
    return L.domain_filter(V.table(spark, sf, "pages"), _DOMAINS).select("page_id", "url")


@register("page_titles", f"""SELECT page_id,
coalesce({_unescape("nullif(regexp_extract(html, '" + H.TITLE + "', 1), '')")}, 'Speiseplan') AS title FROM pages""")
def q_page_titles(spark, sf):
    """B20 with the default title."""
    return L.page_titles(V.table(spark, sf, "pages")).select("page_id", "title")


@register("safe_names", """SELECT page_id, 'page_' || replace(replace(url, '://', '_'), '/', '_') || '.html' AS raw_name,
'cleaned_page_' || replace(replace(url, '://', '_'), '/', '_') || '.html' AS cleaned_name FROM pages""")
def q_safe_names(spark, sf):
    """B19."""
    return L.safe_names(V.table(spark, sf, "pages"), "page_").select("page_id", "raw_name", "cleaned_name")


@register("page_lines", f"""
WITH parts AS (SELECT page_id, string_split_regex({_NON_TEXT}, '{H.TAG}') AS p FROM pages),
rows AS (SELECT page_id, unnest(generate_series(0, len(p) - 1)) AS pos, unnest(p) AS raw FROM parts),
t AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, {_strip(_unescape('raw'))} AS line FROM rows)
SELECT page_id, pos, line FROM t WHERE line <> ''""")
def q_page_lines(spark, sf):
    """B17 as rows."""
    return L.page_lines(V.table(spark, sf, "pages"))


@register("page_text", f"""SELECT page_id, array_to_string(list_filter(list_transform(
string_split_regex({_NON_TEXT}, '{H.TAG}'), lambda x: {_strip(_unescape('x'))}), lambda x: x <> ''), chr(10)) AS text FROM pages""")
def q_page_text(spark, sf):
    """One text per page."""
    return L.page_text(V.table(spark, sf, "pages")).select("page_id", "text")


def _sql_keep_attrs(x: str, safe) -> str:
    allowed = "[" + ", ".join(f"'{a}'" for a in safe) + "]"
    head = "regexp_extract(p, '^[^>]*', 0)"
    kept = (f"list_filter(regexp_extract_all({head}, '([A-Za-z_:][-A-Za-z0-9_:.]*)\\s*=\\s*(\"[^\"]*\"|''[^'']*'')', 0), "
            f"lambda a: list_contains({allowed}, lower(regexp_extract(a, '^([A-Za-z_:][-A-Za-z0-9_:.]*)', 1))))")
    rebuilt = (f"regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*)', 1) || "
               f"CASE WHEN len({kept}) > 0 THEN ' ' || array_to_string({kept}, ' ') ELSE '' END || "
               f"CASE WHEN regexp_matches({head}, '/\\s*$') THEN ' /' ELSE '' END || substr(p, length({head}) + 1)")
    return (f"array_to_string(list_transform(string_split({x}, '<'), lambda p: CASE WHEN "
            f"regexp_matches(p, '^[A-Za-z][A-Za-z0-9]*[\\s/>]') THEN {rebuilt} ELSE p END), '<')")


def _sql_kill(x: str, tags) -> str:
    for t in tags:
        x = f"regexp_replace({x}, '(?is)<{t}\\b[^>]*>.*?</{t}\\s*>|<{t}\\b[^>]*/?>', '', 'g')"
    return x


_CLEAN_BASE = (f"regexp_replace(regexp_replace(html, '{H.SCRIPT_AND_COMMENTS}', '', 'g'), "
               f"'{H.LINK_META}', '', 'g')")


def _sql_js_urls(x: str) -> str:
    return f"regexp_replace({x}, '(?i)((?:href|src)\\s*=\\s*\")\\s*javascript:[^\"]*(\")', '\\1\\2', 'g')"


@register("clean_pages", f"SELECT page_id, {_sql_keep_attrs(_sql_js_urls(_sql_kill(_CLEAN_BASE, H.KILL_TAGS)), H.SAFE_ATTRS)} AS clean_html FROM pages")
def q_clean_pages(spark, sf):
    """Attribute allow-list (src alt href title), object/iframe, scripts, comments, link/meta removed."""
    return L.clean_pages(V.table(spark, sf, "pages")).select("page_id", "clean_html")


@register("minified_pages", "SELECT page_id, regexp_replace(html, '[ \\t\\r\\n\\f]+', ' ', 'g') AS min_html FROM pages")
def q_minified_pages(spark, sf):
    """B16."""
    return L.minify_pages(V.table(spark, sf, "pages")).select("page_id", "min_html")


_META = 'article:modified_time'


@register("page_meta", f"""WITH m AS (SELECT page_id, coalesce(
 nullif(regexp_extract(html, '(?is)<meta\\s[^>]*property\\s*=\\s*"article:modified_time"[^>]*content\\s*=\\s*"([^"]*)"', 1), ''),
 nullif(regexp_extract(html, '(?is)<meta\\s[^>]*content\\s*=\\s*"([^"]*)"[^>]*property\\s*=\\s*"article:modified_time"', 1), ''),
 '') AS meta_value FROM pages)
SELECT page_id, meta_value, coalesce(regexp_matches(meta_value, '^[0-9]{{4}}'), false) AS meta_valid FROM m""")
def q_page_meta(spark, sf):
    """B21 + B22: modified-time meta value and whether it starts with a year."""
    return L.page_meta(V.table(spark, sf, "pages"), _META).select("page_id", "meta_value", "meta_valid")


@register("link_rejects", f"""WITH {LINKS_CTE}, c AS (SELECT page_id, count(*) AS n FROM links GROUP BY page_id)
SELECT p.page_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_items, coalesce(c.n, 0) = 6 AS accepted
FROM pages p LEFT JOIN c USING (page_id)""")
def q_link_rejects(spark, sf):
    """Pages must have exactly six links; every page is judged, none stops the job."""
    pages = V.table(spark, sf, "pages")
    return L.expect_count(L.extract_links(pages, keep=()), pages, "page_id", "==", 6) \
        .select("page_id", "n_items", "accepted")


@register("page_artifacts", f"""SELECT 'page_' || replace(replace(url, '://', '_'), '/', '_') || '.html' AS artifact_name,
'raw' AS kind, CAST(length(html) AS BIGINT) AS n_chars FROM pages
UNION ALL SELECT 'cleaned_page_' || replace(replace(url, '://', '_'), '/', '_') || '.html', 'cleaned',
CAST(length(array_to_string(list_filter(list_transform(string_split_regex({_NON_TEXT}, '{H.TAG}'),
 lambda x: {_strip(_unescape('x'))}), lambda x: x <> ''), chr(10))) AS BIGINT) FROM pages""")
def q_page_artifacts(spark, sf):
    """A6 + B19 + B17: raw and cleaned page text stored under safe names, read back."""
    pages = L.page_text(L.safe_names(V.table(spark, sf, "pages"), "page_"), out="text")
    arts = pages.select(F.col("raw_name").alias("artifact_name"), F.lit("raw").alias("kind"), F.col("html").alias("body")) \
        .unionByName(pages.select(F.col("cleaned_name").alias("artifact_name"), F.lit("cleaned").alias("kind"),
                                  F.col("text").alias("body")))
    path = shared_dir(spark, "artifacts")
    S.write_artifacts(arts, path)
    return spark.read.parquet(path).select("artifact_name", "kind", F.length("body").cast("bigint").alias("n_chars"))


# Node-table queries (B1, B6, B8-B13, B18) on the driver's pages: no SQL oracle; on written pages they have one.
_PLACE = ("pre", "post", "parent_pre", "parent_tag", "depth", "tag")


def _nodes(spark, sf, columns=_PLACE):
    return N.html_nodes(V.table(spark, sf, "pages"), text_tags=(), columns=columns)


@register("html_nodes")
def q_html_nodes(spark, sf):
    """B1: the node table (no text columns, to keep the row check light)."""
    return _nodes(spark, sf, ("pre", "post", "parent_pre", "depth", "sib", "tag", "start_offset", "end_offset"))


@register("first_section_links")
def q_first_section_links(spark, sf):
    """B6 with ul/a: links of the first link-bearing list under each parent."""
    return N.links_in_first_section(_nodes(spark, sf, (*_PLACE, "attrs")), "ul", "a", "/")


@register("parent_blocks")
def q_parent_blocks(spark, sf):
    """Distinct ul parents of li elements."""
    return N.parents_of_tag(_nodes(spark, sf), "li", "ul")


@register("nth_blocks")
def q_nth_blocks(spark, sf):
    """Second paragraph-holding block per page (p parents, n = 1)."""
    return N.nth_block(N.parents_of_tag(_nodes(spark, sf), "p"), 1)


@register("class_parents")
def q_class_parents(spark, sf):
    """Parents of div elements whose class holds 'ad'."""
    return N.parents_of_class(_nodes(spark, sf, (*_PLACE, "attrs")), "div", "ad")


BLOCK_COLUMNS = (*_PLACE, "attrs", "string_value", "text_start", "text_end", "has_text", "page_text", "start_offset", "end_offset")


def chosen_documents(spark, pages, heading, container, words):
    """Each page's chosen block as a document of its own; the node table is written once for all branches."""
    nodes = materialize(N.html_nodes(pages, text_tags=(heading[0],), columns=BLOCK_COLUMNS), "nodes", spark)
    primary = N.heading_container(nodes, *heading, *container)
    fallback = N.keyword_container(nodes, words, "div")
    return N.block_documents(N.coalesce_blocks(primary, fallback), nodes, pages)


@register("chosen_blocks")
def q_chosen_blocks(spark, sf):
    """B11-B13 + B18 + B17: container of the h1 heading (else the keyword block), wrapped and reduced to text."""
    doc = chosen_documents(spark, V.table(spark, sf, "pages"), ("h1", "the"), ("article", "post"), ["nicht", "the"])
    return doc.select("page_id", "pre", "strategy", H.text_lines(F.col("doc")).alias("text"))


# ---------------------------------------------------------------- C: menu extraction
@register("doc_lines", f"""
WITH s AS (SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents),
r AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line FROM s)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, {_strip('line')} AS line FROM r""")
def q_doc_lines(spark, sf):
    """C1 over whole documents."""
    return C.to_lines(V.table(spark, sf, "documents"))


_NOTICE_SQL = (r"(regexp_matches(line, '(^|[^\p{L}])(wünsche|wünschen|wünscht|kein separates|Feiertag|Feiertage|Feiertags|Feiertagen|Feiertages)([^\p{L}]|$)') "
               r"AND NOT regexp_matches(line, '[0-9]+[.,][0-9][0-9]'))")
_SEP_SQL = "'oder'"


@register("menu_lines", f"""
WITH s AS (SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents),
r AS (SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line FROM s),
t AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, {_strip('line')} AS line FROM r)
SELECT doc_id, pos, line FROM t WHERE line <> '' AND lower(line) NOT IN ({_SEP_SQL}) AND NOT ({_NOTICE_SQL})""")
def q_menu_lines(spark, sf):
    """C1 + C11 + C18: candidate meal lines (no blanks, separators or notices)."""
    lines = C.flag_notices(C.to_lines(V.table(spark, sf, "documents")))
    return C.split_alternatives(lines.filter((F.col("line") != "") & ~F.col("is_notice"))).select("doc_id", "pos", "line")


@register("notices", f"""
WITH s AS (SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents),
r AS (SELECT doc_id, unnest(l) AS line FROM s),
t AS (SELECT doc_id, {_strip('line')} AS line FROM r)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE {_NOTICE_SQL}) AS n_notices FROM t GROUP BY doc_id""")
def q_notices(spark, sf):
    """C11: notice lines per document."""
    lines = C.flag_notices(C.to_lines(V.table(spark, sf, "documents")))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.count(F.when(F.col("is_notice"), 1)).alias("n_notices"))


@register("line_sections", """SELECT conv_id, turn, role,
last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_pos
FROM conversations""")
def q_line_sections(spark, sf):
    """Every turn belongs to the last user turn at or above it (chunked scan: a long conversation is split)."""
    conv = V.table(spark, sf, "conversations")
    out = C.assign_sections(conv, F.when(F.col("role") == "user", F.col("role")), key="conv_id", pos="turn",
                            chunk=4096)
    return out.select("conv_id", "turn", "role", "section_pos")


_FMT = "replace(CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR), '.', ',') || ' €'"


@register("parsed_prices", f"""
WITH t AS (SELECT event_id, props || ' ' || {_FMT} || ' inkl. Getränk' AS line FROM events)
SELECT event_id, CASE WHEN regexp_matches(line, '([0-9]+[.,][0-9]{{2}}) ?€')
  THEN trim(regexp_extract(line, '^(.*?)\\s*([0-9]+[.,][0-9]{{2}}) ?€', 1)) ELSE trim(line) END AS "desc",
  TRY_CAST(replace(nullif(regexp_extract(line, '([0-9]+[.,][0-9]{{2}}) ?€', 1), ''), ',', '.') AS DECIMAL(10,2)) AS price
FROM t""")
def q_parsed_prices(spark, sf):
    """C5 + C7: price text written as a menu line and parsed back; text after the euro sign dropped."""
    ev = V.table(spark, sf, "events")
    line = F.concat(F.col("props"), F.lit(" "), format_price(F.col("value")), F.lit(" inkl. Getränk"))
    desc, price = split_desc_price(line)
    return ev.select("event_id", desc.alias("desc"), price.alias("price"))


@register("prices_normalized", f"""SELECT event_id, json_extract_string(props, '$.k') AS price_raw,
TRY_CAST(nullif(trim(json_extract_string(props, '$.k')), '') AS DECIMAL(10,2)) AS price,
{_status("json_extract_string(props, '$.k')")} AS price_status FROM events""")
def q_prices_normalized(spark, sf):
    """F1 on JSON price text."""
    ev = V.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("price_raw"))
    return Q.normalize_price(ev, "price_raw")


@register("weekday_spine", f"""
WITH {OFFERS_CTE},
d AS (SELECT location, CAST(offer_key AS DATE) AS day FROM offers WHERE key_kind = 'day'),
weeks AS (SELECT DISTINCT location, CAST(date_trunc('week', day) AS DATE) AS m FROM d),
spine AS (SELECT location, CAST(unnest(generate_series(m, m + INTERVAL 4 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM weeks),
c AS (SELECT location, day, count(*) AS n FROM d GROUP BY ALL)
SELECT s.location, s.day, CAST(coalesce(c.n, 0) AS BIGINT) AS n_meals FROM spine s LEFT JOIN c USING (location, day)""")
def q_weekday_spine(spark, sf):
    """Every Monday-Friday of each week with offers, with its meal count (0 = empty day)."""
    d = V.offers(spark, sf).filter(F.col("key_kind") == "day").select("location", F.to_date("offer_key").alias("day"))
    weeks = d.select("location", week_monday("day").alias("m")).distinct()
    spine = weeks.select("location", F.explode(F.sequence("m", F.date_add("m", 4))).alias("day"))
    counts = d.groupBy("location", "day").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, ["location", "day"], "left").select(
        "location", "day", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_meals"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("unpivoted", f"""SELECT l_orderkey, l_linenumber, measure, value FROM
(SELECT l_orderkey, l_linenumber, {', '.join(_MEASURES)} FROM lineitem)
UNPIVOT (value FOR measure IN ({', '.join(_MEASURES)}))""")
def q_unpivoted(spark, sf):
    """One row per (line, measure); empty cells skipped."""
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_MEASURES)
    return C.unpivot_week_table(li, ["l_orderkey", "l_linenumber"], _MEASURES, "measure", "value")


@register("transposed", """SELECT 'r_name' AS field,
max(CASE WHEN r_regionkey = 0 THEN r_name END) AS "0", max(CASE WHEN r_regionkey = 1 THEN r_name END) AS "1",
max(CASE WHEN r_regionkey = 2 THEN r_name END) AS "2", max(CASE WHEN r_regionkey = 3 THEN r_name END) AS "3",
max(CASE WHEN r_regionkey = 4 THEN r_name END) AS "4" FROM region""")
def q_transposed(spark, sf):
    """Region rows become columns (unpivot + pivot, pivot values found by Spark)."""
    return C.transpose_table(V.table(spark, sf, "region"), "r_regionkey", ["r_name"])


@register("dated_meals", f"""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority || ' ' || replace(CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR), '.', ',') || ' € inkl. Getränk' AS m1,
  'Beilage ' || o_orderstatus AS m2 FROM orders),
u AS (SELECT * FROM o UNPIVOT (cell FOR slot IN (m1, m2)))
SELECT o_orderkey, o_orderdate AS day, slot,
  regexp_replace(regexp_replace(CASE WHEN regexp_matches(cell, '([0-9]+[.,][0-9]{{2}}) ?€')
     THEN trim(regexp_extract(cell, '^(.*?)\\s*([0-9]+[.,][0-9]{{2}}) ?€', 1)) ELSE trim(cell) END,
     '[\\s\\x{{A0}}\\x00-\\x1F\\x7F]+', ' ', 'g'), '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g') AS "desc",
  TRY_CAST(replace(nullif(regexp_extract(cell, '([0-9]+[.,][0-9]{{2}}) ?€', 1), ''), ',', '.') AS DECIMAL(10,2)) AS price
FROM u WHERE {_strip('cell')} <> ''""")
def q_dated_meals(spark, sf):
    """C17: one row per date with meal columns -> dated meals with prices."""
    o = V.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"),
        F.concat(F.col("o_orderpriority"), F.lit(" "), format_price(F.col("o_totalprice")), F.lit(" inkl. Getränk")).alias("m1"),
        F.concat(F.lit("Beilage "), F.col("o_orderstatus")).alias("m2"))
    return C.dated_rows_to_meals(o, "o_orderdate", ["m1", "m2"], id_cols=["o_orderkey"])


@register("side_dishes", """SELECT o_orderkey, CAST(0 AS BIGINT) AS idx, o_orderpriority AS "desc" FROM orders
  WHERE o_orderpriority IS NOT NULL AND regexp_replace(o_orderpriority, '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') <> ''
UNION ALL SELECT o_orderkey, CAST(1 AS BIGINT), o_orderstatus FROM orders
  WHERE o_orderstatus IS NOT NULL AND regexp_replace(o_orderstatus, '^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g') <> ''""")
def q_side_dishes(spark, sf):
    """Main and side dish become own meals, in order."""
    return C.side_dishes(V.table(spark, sf, "orders"), "o_orderpriority", ["o_orderstatus"], keep=["o_orderkey"])


_CLEAN_SQL = ("regexp_replace(regexp_replace(text, '[\\s\\x{A0}\\x00-\\x1F\\x7F]+', ' ', 'g'), "
              "'^[\\s\\x{A0}]+|[\\s\\x{A0}]+$', '', 'g')")
# a code list: one or two letters, a token with digits, or several tokens joined by commas or dots
_CODES_SQL = ("\\s+([a-n]|[a-n][a-nwA-Z]|[a-z][a-zA-Z0-9]*([,.][a-zA-Z0-9]+)+|[a-z][a-zA-Z]?[a-zA-Z]?[a-zA-Z]?[0-9][a-zA-Z0-9]*"
              "|[0-9]+(,[0-9a-z]+)+)$")


@register("clean_descs", f"""WITH c AS (SELECT conv_id, turn, {_CLEAN_SQL} AS t FROM conversations)
SELECT conv_id, turn, CASE WHEN regexp_matches(t, '\\s(ab|am|an|da|im|in|ja|be|he|if|me|[0-9]+,[0-9][0-9])$') THEN t
  ELSE regexp_replace(t, '{_CODES_SQL}', '', 'g') END AS "desc" FROM c""")
def q_clean_descs(spark, sf):
    """C14 + C8: line breaks and control characters removed, trailing code lists stripped."""
    conv = V.table(spark, sf, "conversations")
    return conv.select("conv_id", "turn", strip_footnotes(clean_desc(F.col("text"))).alias("desc"))


# ---------------------------------------------------------------- E: incremental
@register("new_links", f"""WITH {LINKS_CTE},
abs AS (SELECT page_id, url AS page_url,
  CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links),
seen AS (SELECT DISTINCT url FROM abs WHERE starts_with(page_url, 'http://'))
SELECT DISTINCT a.url FROM abs a WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.url = a.url)""")
def q_new_links(spark, sf):
    """Links of this run not processed by the earlier run (the run over http pages)."""
    links = L.extract_links(V.table(spark, sf, "pages"))
    abs_links = L.absolutize(links, L.site_base("url"), out="abs_url") \
        .select(F.col("url").alias("page_url"), F.col("abs_url").alias("url"))
    seen = abs_links.filter(F.col("page_url").startswith("http://")).select("url")
    # de-duplicate before the anti join: a url on every page collapses map-side
    return E.new_links(abs_links.select("url").distinct(), seen)


_CUTOFF = "2024-01-15"


@register("changed_items", f"""
WITH state AS (SELECT event_type, max(ts) AS high_water FROM events WHERE ts < TIMESTAMP '{_CUTOFF}' GROUP BY event_type)
SELECT e.event_id, e.event_type, e.ts FROM events e LEFT JOIN state s USING (event_type)
WHERE e.ts IS NOT NULL AND (s.high_water IS NULL OR e.ts > s.high_water)""")
def q_changed_items(spark, sf):
    """Items newer than the stored high-water mark of their key (state from the earlier run)."""
    ev = V.table(spark, sf, "events")
    state = E.advance_state(ev.filter(F.col("ts") < F.lit(_CUTOFF).cast("timestamp_ntz")), None, "event_type", "ts")
    return E.changed_pages(ev, state, "event_type", "ts").select("event_id", "event_type", "ts")


@register("advanced_state", f"""
WITH state AS (SELECT event_type, max(ts) AS high_water FROM events WHERE ts < TIMESTAMP '{_CUTOFF}' GROUP BY event_type),
changed AS (SELECT e.* FROM events e LEFT JOIN state s USING (event_type) WHERE e.ts IS NOT NULL AND (s.high_water IS NULL OR e.ts > s.high_water)),
u AS (SELECT event_type, max(ts) AS high_water FROM changed GROUP BY event_type UNION ALL SELECT * FROM state)
SELECT event_type, max(high_water) AS high_water FROM u GROUP BY event_type""")
def q_advanced_state(spark, sf):
    """New high-water marks after processing the changed items."""
    ev = V.table(spark, sf, "events")
    state = E.advance_state(ev.filter(F.col("ts") < F.lit(_CUTOFF).cast("timestamp_ntz")), None, "event_type", "ts")
    changed = E.changed_pages(ev, state, "event_type", "ts")
    return E.advance_state(changed, state, "event_type", "ts")


@register("latest_per_week", f"""
WITH r AS (SELECT event_id, event_type AS location, {_iso(_D)} AS file_week, {_D} AS run_day FROM events),
m AS (SELECT location, file_week, max(run_day) AS run_day FROM r GROUP BY ALL)
SELECT r.event_id, r.location, r.file_week, r.run_day FROM r JOIN m USING (location, file_week, run_day)""")
def q_latest_per_week(spark, sf):
    """Per (location, week) only the rows of the latest run (day)."""
    r = V.table(spark, sf, "events").select("event_id", F.col("event_type").alias("location"),
                                           week_label(F.to_date("ts"), "iso").alias("file_week"),
                                           F.to_date("ts").alias("run_day"))
    return E.latest_per_week(r, ("location", "file_week"), "run_day")


@register("stream_offers", f"WITH {OFFERS_CTE} SELECT location, key_kind, offer_key, pos, \"desc\", price FROM offers")
def q_stream_offers(spark, sf):
    """Arriving event files as a stream, each row taken once, stored, read back."""
    from offerboard.streaming.offers_stream import run_offers_stream
    out = run_offers_stream(spark, sf)
    return spark.read.parquet(out).select("location", "key_kind", "offer_key", "pos", "desc", "price")


@register("stream_new_links", f"""WITH {LINKS_CTE} SELECT DISTINCT
CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links""")
def q_stream_new_links(spark, sf):
    """Streaming seen-set: each absolute link is emitted once over all arriving pages."""
    from offerboard.streaming.offers_stream import run_new_links_stream
    return spark.read.parquet(run_new_links_stream(spark, sf)).select("url")  # every url once over all epochs


# ---------------------------------------------------------------- F: quality
@register("duplicates", f"""WITH {OFFERS_CTE} SELECT location, offer_key, "desc", count(*) AS n FROM offers
WHERE "desc" IS NOT NULL GROUP BY ALL HAVING count(*) > 1""")
def q_duplicates(spark, sf):
    """F3."""
    return Q.duplicate_meals(V.offers(spark, sf))


@register("key_checks", f"""WITH {OFFERS_CTE}, k AS (SELECT DISTINCT location, file_week, offer_key FROM offers),
c AS (SELECT *, CASE WHEN regexp_matches(offer_key, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST(offer_key AS DATE) END AS day,
  regexp_matches(offer_key, '^[0-9]{{4}}-W[0-9]{{2}}$') AS is_week,
  TRY_CAST(nullif(regexp_extract(offer_key, '^([0-9]{{4}})-W', 1), '') AS INTEGER) AS wy,
  TRY_CAST(nullif(regexp_extract(offer_key, '-W([0-9]{{2}})$', 1), '') AS INTEGER) AS wn FROM k)
SELECT location, file_week, offer_key,
  CASE WHEN day IS NOT NULL THEN 'day' WHEN is_week THEN 'week' ELSE 'other' END AS key_kind,
  coalesce(isodow(day) >= 6, false) AS is_weekend,
  CASE WHEN is_week THEN wn < 1 OR wn > week(make_date(wy, 12, 28)) ELSE false END AS bad_week,
  coalesce(CASE WHEN day IS NOT NULL THEN {_iso('day')} WHEN is_week THEN offer_key END
           <> regexp_replace(file_week, '^([0-9]{{4}})-W?([0-9]{{2}})$', '\\1-W\\2'), false) AS week_mismatch
FROM c""")
def q_key_checks(spark, sf):
    """key kind, weekend keys, impossible weeks, keys outside their file's week."""
    keys = V.offers(spark, sf).select("location", "file_week", "offer_key").distinct()
    return Q.check_keys(keys).select("location", "file_week", "offer_key", "key_kind", "is_weekend", "bad_week",
                                     "week_mismatch")


_RUN_A = "2024-01-20"


@register("run_diff", f"""WITH {OFFERS_CTE},
a AS (SELECT o.location, o.offer_key, o.pos, o."desc", o.price FROM offers o JOIN events e ON e.event_id = o.pos
      WHERE e.ts < TIMESTAMP '{_RUN_A}'),
b AS (SELECT location, offer_key, pos, "desc", TRY_CAST(json_extract_string("desc", '$.k') AS DECIMAL(10,2)) AS price FROM offers),
j AS (SELECT coalesce(a.location, b.location) AS location, coalesce(a.offer_key, b.offer_key) AS offer_key,
        coalesce(a.pos, b.pos) AS pos, a."desc" AS a_desc, a.price AS a_price, b."desc" AS b_desc, b.price AS b_price,
        a.pos IS NOT NULL AS in_a, b.pos IS NOT NULL AS in_b
      FROM a FULL OUTER JOIN b ON a.location = b.location AND a.offer_key = b.offer_key AND a.pos = b.pos)
SELECT location, offer_key, pos, a_desc, a_price, b_desc, b_price,
  CASE WHEN NOT in_a THEN 'added' WHEN NOT in_b THEN 'removed'
       WHEN a_desc IS NOT DISTINCT FROM b_desc AND a_price IS NOT DISTINCT FROM b_price THEN 'same' ELSE 'changed' END AS status
FROM j""")
def q_run_diff(spark, sf):
    """an earlier run (prices from the value, events before a date) against a later run (prices from props)."""
    ev = V.table(spark, sf, "events")
    a = V.offers_from_events(ev.filter(F.col("ts") < F.lit(_RUN_A).cast("timestamp_ntz")))
    b = V.offers_from_events(ev).withColumn("price", F.get_json_object("desc", "$.k").try_cast(PRICE_TYPE))
    return Q.diff_runs(a.select("location", "offer_key", "pos", "desc", "price"),
                       b.select("location", "offer_key", "pos", "desc", "price"))


_CASES = [{"provider": "rules", "model": "plain"}, {"provider": "rules", "model": "clean"}]


@register("case_matrix", f"""WITH cases(provider, model) AS (VALUES ('rules', 'plain'), ('rules', 'clean'))
SELECT d.doc_id, c.provider, c.model,
  CAST(CASE WHEN c.model = 'clean' THEN length(regexp_replace(regexp_replace(d.text, '[\\s\\x{{A0}}\\x00-\\x1F\\x7F]+', ' ', 'g'),
       '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g')) ELSE length(d.text) END AS BIGINT) AS n_chars
FROM documents d CROSS JOIN cases c""")
def q_case_matrix(spark, sf):
    """every document under every variant, result per variant."""
    m = Q.run_matrix(V.table(spark, sf, "documents").select("doc_id", "text"), _CASES)
    n = F.when(F.col("model") == "clean", F.length(clean_desc(F.col("text")))).otherwise(F.length("text"))
    return m.select("doc_id", "provider", "model", n.cast("bigint").alias("n_chars"))


@register("usage_summary", """
WITH w AS (SELECT conv_id, role, CAST(len(list_filter(string_split_regex(text, '[ \\t\\r\\n]+'), lambda x: x <> '')) AS BIGINT) AS n FROM conversations),
u AS (SELECT CAST(conv_id AS VARCHAR) AS location, 'rules' AS provider, 'words' AS model,
        CASE WHEN role = 'assistant' THEN 0 ELSE n END AS prompt_tokens,
        CASE WHEN role = 'assistant' THEN n ELSE 0 END AS completion_tokens, n AS total_tokens FROM w)
SELECT location, provider, model, count(*) AS n_records, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
  CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  bool_and(coalesce(total_tokens = prompt_tokens + completion_tokens, false)) AS totals_ok
FROM u GROUP BY ALL""")
def q_usage_summary(spark, sf):
    """word-token usage records per conversation turn, summed per conversation."""
    conv = V.table(spark, sf, "conversations")
    n = word_count(F.col("text")).cast("bigint")
    usage = conv.select(F.col("conv_id").cast("string").alias("location"), F.lit("rules").alias("provider"),
                        F.lit("words").alias("model"),
                        F.when(F.col("role") == "assistant", F.lit(0).cast("bigint")).otherwise(n).alias("prompt_tokens"),
                        F.when(F.col("role") == "assistant", n).otherwise(F.lit(0).cast("bigint")).alias("completion_tokens"),
                        n.alias("total_tokens"))
    return Q.usage_summary(usage)


@register("doc_first_lines", f"""SELECT doc_id, {_strip("string_split_regex(text, '\\r?\\n')[1]")} AS text FROM documents""")
def q_doc_first_lines(spark, sf):
    """A7 first-line variant: line 0 of every text."""
    return S.document_text(C.to_lines(V.table(spark, sf, "documents")), first_only=True)


@register("csv_roundtrip", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def q_csv_roundtrip(spark, sf):
    """Write a table as header-less CSV, scan it back with a column subset."""
    path = shared_dir(spark, "csv")
    S.csv_sink(V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), path)
    cells = R.scan_csv_table(spark, path, header=False, glob="*.csv")
    return R.csv_table_columns(cells, ["o_orderkey", "o_orderstatus", "o_orderpriority"], keep_cols=[0, 2, 3]) \
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")


@register("stream_seen_links", f"""WITH {LINKS_CTE} SELECT DISTINCT
CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links""")
def q_stream_seen_links(spark, sf):
    """E1 + E5 over a stream: per micro-batch, new urls appended to a seen table (foreachBatch)."""
    from offerboard.streaming.offers_stream import run_seen_table_stream
    return run_seen_table_stream(spark, sf).urls()


_DOC_KEY = ("event_type || '/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') || '/' || "
            f"CAST(CAST(floor(event_id / {V.MENU_CHUNK}) AS BIGINT) AS VARCHAR)")


@register("text_menus", f"""SELECT {_DOC_KEY} AS doc_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS offer_key, 'day' AS key_kind,
  CAST(2 + row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), floor(event_id / {V.MENU_CHUNK}) ORDER BY event_id) AS BIGINT) AS pos,
  props AS "desc", CAST(value AS DECIMAL(10,2)) AS price
FROM events""")
def q_text_menus(spark, sf):
    """Menu texts written from events, extracted back to dated offers."""
    docs = V.menu_documents(spark, sf).select("doc_id", "text")
    return C.extract_text_menu(docs, max_meals=None, keep_empty_days=False)


def _site_texts(spark, sf):
    """Menu texts of five sites with different rules: (doc_id, text, run_date, max_meals, all_week, keep_empty).

    ``click`` and ``purchase`` texts have no period line; ``click`` runs on the
    menu's date, ``purchase`` has no date at all.
    """
    docs = V.menu_documents(spark, sf)
    day = F.to_date(F.split("doc_id", "/")[1])
    undated = F.col("location").isin("click", "purchase")
    return docs.select(
        "doc_id", F.when(undated, F.regexp_replace("text", r"^([^\n]*)\n[^\n]*\n", "$1\n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("location") == "click", day).alias("run_date"),
        F.when(F.col("location") == "error", F.lit(2)).alias("max_meals"),
        F.when(F.col("location") == "view", F.lit(True)).alias("all_week"),
        F.when(F.col("location") == "signup", F.lit(True)).alias("keep_empty"))


@register("site_menus", f"""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS d, {_DOC_KEY} AS doc_id, props, value,
  row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), floor(event_id / {V.MENU_CHUNK}) ORDER BY event_id) AS rn FROM events),
week AS (SELECT DISTINCT doc_id, d, CAST(unnest(generate_series(CAST(date_trunc('week', d) AS DATE),
  CAST(date_trunc('week', d) AS DATE) + INTERVAL 4 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM e WHERE event_type = 'signup')
SELECT doc_id, CASE WHEN event_type = 'view' THEN {_iso('d')} ELSE strftime(d, '%Y-%m-%d') END AS offer_key,
  CASE WHEN event_type = 'view' THEN 'week' ELSE 'day' END AS key_kind,
  CAST(rn + CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS BIGINT) AS pos,
  props AS "desc", CAST(value AS DECIMAL(10,2)) AS price
FROM e WHERE event_type <> 'purchase' AND (event_type <> 'error' OR rn <= 2)
UNION ALL SELECT doc_id, strftime(day, '%Y-%m-%d'), 'day', NULL, NULL, NULL FROM week WHERE day <> d""")
def q_site_menus(spark, sf):
    """One extraction over texts of sites with different rules, read from columns."""
    return C.extract_text_menu(_site_texts(spark, sf), keep_empty_days=False, settings=("run_date", "max_meals", "all_week", "keep_empty"))


@register("text_menu_rejects", f"""SELECT DISTINCT {_DOC_KEY} AS doc_id, 'no period' AS reason FROM events
WHERE event_type = 'purchase'""")
def q_text_menu_rejects(spark, sf):
    """Texts that cannot be dated come out as rejects."""
    return C.text_menu_rejects(_site_texts(spark, sf), run_date="run_date")


_EDGE = "CASE WHEN event_id % 4 = 0 THEN 'K&auml;se &ndash; gr&#252;n &amp;lt; &unknown; ' WHEN event_id % 4 = 1 THEN 'Brot &#x20AC; &copy ' ELSE '' END"


@register("entity_texts", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Käse – grün &lt; &unknown; ' WHEN event_id % 4 = 1 THEN 'Brot € &copy '
  ELSE '' END || props AS text FROM events""")
def q_entity_texts(spark, sf):
    """Named, decimal and hexadecimal references, each decoded once."""
    from offerboard.functions.text import html_unescape
    ev = V.table(spark, sf, "events")
    return ev.select("event_id", html_unescape(F.concat(F.expr(_EDGE), "props")).alias("text"))


@register("edge_prices", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Braten' WHEN 1 THEN 'Suppe' WHEN 2 THEN 'Los 12.345.6' ELSE 'Brot 5 €' END
    AS "desc",
  CASE event_id % 4 WHEN 0 THEN CAST(value AS DECIMAL(10,2)) + 1000 * (1 + event_id % 9)
    WHEN 1 THEN CAST(value AS DECIMAL(10,2)) END AS price
FROM (SELECT event_id, value - floor(value) AS value FROM events)""")
def q_edge_prices(spark, sf):
    """Thousands, the no-break space, and texts without a price."""
    ev = V.table(spark, sf, "events").select("event_id", (F.col("value") - F.floor("value")).cast("decimal(10,2)").alias("v"))
    cents = F.replace(F.substring(F.col("v").cast("string"), -2, 2), F.lit("."), F.lit(","))
    text = (F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("Braten "), (1 + F.col("event_id") % 9).cast("string"), F.lit(".000,"), cents, F.lit(" €")))
            .when(F.col("event_id") % 4 == 1, F.concat(F.lit("Suppe 0,"), cents, F.lit("\u00a0€")))
            .when(F.col("event_id") % 4 == 2, F.lit("Los 12.345.6")).otherwise(F.lit("Brot 5 €")))
    desc, price = split_desc_price(text)
    return ev.select("event_id", desc.alias("desc"), price.alias("price"))


@register("html_menus", f"""SELECT event_type AS location,
  CASE WHEN event_type = '{V.WEEK_LOCATION}' THEN {_iso('CAST(date_trunc(' + "'week'" + ', CAST(ts AS DATE)) AS DATE)')}
       ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS offer_key,
  CASE WHEN event_type = '{V.WEEK_LOCATION}' THEN 'week' ELSE 'day' END AS key_kind,
  CAST(1 + 3 * row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), floor(event_id / {V.MENU_CHUNK}) ORDER BY event_id) AS BIGINT) AS pos,
  props AS "desc", CAST(value AS DECIMAL(10,2)) AS price
FROM events""")
def q_html_menus(spark, sf):
    """B1 + C2-C5, C9-C11: HTML menus written from events, parsed into nodes, extracted back to offers."""
    nodes = N.html_nodes(V.menu_documents(spark, sf, html=True), columns=C.HTML_MENU_COLUMNS, keys=("location",))
    return C.extract_html_menu(nodes, keep_empty_days=False, keep=("location",)) \
        .select("location", "offer_key", "key_kind", "pos", "desc", "price")


# Fixed configuration rows of the site rules query: (domain, location, max_meals, empty_policy)
_RULES = [("example.org", "org sites", 2, "keep"), ("example.com", "com sites", 3, "drop"),
          ("blog.tiontion.example.com", "one blog", None, "keep")]
_OVERRIDES = [("example.com", 5)]


@register("site_rules", f"""
WITH rules(host, location, max_meals, empty_policy) AS (VALUES {', '.join(f"('{h}', '{l}', {'NULL' if m is None else m}, '{e}')" for h, l, m, e in _RULES)}),
over(host, max_meals) AS (VALUES {', '.join(f"('{h}', {m})" for h, m in _OVERRIDES)}),
merged AS (SELECT r.host, r.location, coalesce(o.max_meals, r.max_meals) AS max_meals, r.empty_policy
           FROM rules r LEFT JOIN over o USING (host)),
p AS (SELECT page_id, url, {_HOST} AS h FROM pages),
hits AS (SELECT p.page_id, m.* FROM p JOIN merged m ON p.h = m.host OR ends_with(p.h, '.' || m.host)),
best AS (SELECT page_id, arg_max(host, length(host)) AS rule_host FROM hits GROUP BY page_id)
SELECT p.page_id, p.url, b.rule_host, m.location, CAST(m.max_meals AS INTEGER) AS max_meals, m.empty_policy
FROM p LEFT JOIN best b USING (page_id) LEFT JOIN merged m ON m.host = b.rule_host""")
def q_site_rules(spark, sf):
    """Per-site settings by longest matching domain, with an override layer."""
    rules = literal_table(spark, _RULES, [("host", "string"), ("location", "string"), ("max_meals", "int"),
                                          ("empty_policy", "string")])
    over = literal_table(spark, _OVERRIDES, [("host", "string"), ("max_meals", "int")])
    return C.apply_site_rules(V.table(spark, sf, "pages").select("page_id", "url"), rules, over)


@register("run_weekdays", f"""SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
  CAST(unnest(generate_series(CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE),
       CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) + INTERVAL 4 DAY, INTERVAL 1 DAY)) AS DATE) AS weekday
FROM orders""")
def q_run_weekdays(spark, sf):
    """The Monday-Friday dates a run on each order date works with (addCurrentWeekdays)."""
    d = V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    m = F.to_date(F.date_trunc("week", F.col("d")))
    return d.select("d", F.explode(F.sequence(m, F.date_add(m, 4))).alias("weekday"))


@register("node_tag_counts", """
WITH t AS (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                                     '<([A-Za-z][A-Za-z0-9]*)', 1)) AS tag FROM pages)
SELECT page_id, lower(tag) AS tag, count(*) AS n FROM t GROUP BY ALL""")
def q_node_tag_counts(spark, sf):
    """B1 checked from outside: elements per page and tag equal the page's start tags."""
    return _nodes(spark, sf, ("tag",)).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@register("node_order", """
WITH t AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                                              '<([A-Za-z][A-Za-z0-9]*)', 1) AS tags FROM pages)
SELECT page_id, CAST(unnest(generate_series(0, len(tags) - 1)) AS INTEGER) AS pre, lower(unnest(tags)) AS tag FROM t""")
def q_node_order(spark, sf):
    """B1 document order: ``pre`` is the start tag's position among the page's start tags."""
    return _nodes(spark, sf, ("pre", "tag"))


# ---------------------------------------------------------------- pages and documents written from tables
def _written_nodes(spark, sf, columns=_PLACE):
    """Nodes of one page per order: three sections, a list and links; every fifth page has none of them."""
    k = F.col("o_orderkey").cast("string")
    first = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('<a href="/first-'), k, F.lit('.pdf">f</a>'))) \
        .otherwise(F.lit("<a href='/x'>x</a>"))
    page = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("<p>nothing "), k, F.lit("</p>"))).otherwise(F.concat(
        F.lit('<div class="wrap"><section>'), first, F.lit('</section><section class="menu wide"><p><a href="/menu-'), k,
        F.lit('.pdf">m</a></p></section><ul><li>x</li></ul><section><a href="/other-'), k, F.lit('.pdf">o</a></section></div>')))
    pages = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), page.alias("html"))
    return N.html_nodes(pages, text_tags=(), columns=columns)


@register("written_section_links", """
SELECT CAST(o_orderkey AS BIGINT) AS page_id, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 5 END AS INTEGER) AS pre,
  CASE WHEN o_orderkey % 3 = 0 THEN '/first-' ELSE '/menu-' END || CAST(o_orderkey AS VARCHAR) || '.pdf' AS href
FROM orders WHERE o_orderkey % 5 <> 0""")
def q_written_section_links(spark, sf):
    """Links of the first section that holds a pdf link; pages without one give nothing."""
    return N.links_in_first_section(_written_nodes(spark, sf, (*_PLACE, "attrs")), "section", "a", "pdf")


@register("written_link_parents", """
SELECT CAST(o_orderkey AS BIGINT) AS page_id, CAST(x.pre AS INTEGER) AS pre, x.tag
FROM orders, (VALUES (1, 'section'), (4, 'p'), (8, 'section')) x(pre, tag) WHERE o_orderkey % 5 <> 0""")
def q_written_link_parents(spark, sf):
    """Distinct parents of links."""
    return N.parents_of_tag(_written_nodes(spark, sf), "a")


@register("written_second_blocks", """
SELECT CAST(o_orderkey AS BIGINT) AS page_id, CAST(8 AS INTEGER) AS pre, 'section' AS tag FROM orders WHERE o_orderkey % 5 <> 0""")
def q_written_second_blocks(spark, sf):
    """The second section that is a link's parent."""
    return N.nth_block(N.parents_of_tag(_written_nodes(spark, sf), "a", "section"), 1)


@register("written_class_parents", """
SELECT CAST(o_orderkey AS BIGINT) AS page_id, CAST(0 AS INTEGER) AS pre, 'div' AS tag FROM orders WHERE o_orderkey % 5 <> 0""")
def q_written_class_parents(spark, sf):
    """Parents of sections whose class holds a word."""
    return N.parents_of_class(_written_nodes(spark, sf, (*_PLACE, "attrs")), "section", "menu")


def _archive_documents(spark, sf):
    """Offers documents written from events, one per (type, day, chunk); those of ``error`` are no valid JSON."""
    ev = V.table(spark, sf, "events")
    day, part = F.to_date("ts"), F.floor(F.col("event_id") / V.MENU_CHUNK).cast("bigint")
    docs = ev.groupBy(F.col("event_type").alias("location"), day.alias("day"), part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", F.col("props").alias("desc"),
                                             F.col("value").cast("decimal(10,2)").alias("price")))).alias("l"))
    meals = F.to_json(F.transform("l", lambda x: F.struct(x["desc"].alias("desc"), x["price"].alias("price"))))
    key = F.date_format("day", "yyyy-MM-dd")
    return docs.select(
        F.concat(F.lit('{"'), key, F.lit('": '), meals, F.when(F.col("location") == "error", F.lit("")).otherwise(F.lit("}"))).alias("value"),
        F.concat_ws("", F.lit("archive/"), "location", F.lit("/"), week_label("day", "iso"), F.lit("@"), key, F.lit("-"),
                    F.col("part").cast("string"), F.lit(".json")).alias("file_path"))


_ARCHIVE_RUN = f"strftime(CAST(ts AS DATE), '%Y-%m-%d') || '-' || CAST(CAST(floor(event_id / {V.MENU_CHUNK}) AS BIGINT) AS VARCHAR)"


@register("archive_offers", f"""
SELECT event_type AS location, {_iso('CAST(ts AS DATE)')} AS file_week, {_ARCHIVE_RUN} AS run,
  strftime(CAST(ts AS DATE), '%Y-%m-%d') AS offer_key,
  CAST(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), floor(event_id / {V.MENU_CHUNK}) ORDER BY event_id) - 1 AS BIGINT) AS pos,
  props AS "desc", CAST(value AS DECIMAL(10,2)) AS price
FROM events WHERE event_type <> 'error'""")
def q_archive_offers(spark, sf):
    """A1 + F1: offers documents (JSON) as long rows."""
    from offerboard.operators.quality import normalize_price
    return normalize_price(R.parse_offers_documents(_archive_documents(spark, sf))) \
        .select("location", "file_week", "run", "offer_key", "pos", "desc", "price")


@register("archive_rejects", f"""
SELECT DISTINCT 'archive/error/' || {_iso('CAST(ts AS DATE)')} || '@' || {_ARCHIVE_RUN} || '.json' AS file_path,
  'not an offers document' AS reason FROM events WHERE event_type = 'error'""")
def q_archive_rejects(spark, sf):
    """A1: documents that are no valid JSON come out as rejects."""
    return R.offers_document_rejects(_archive_documents(spark, sf))


@register("board_lists", f"""
WITH {OFFERS_CTE}, {SELECTED_CTE}
SELECT location, section, CAST(row_number() OVER (PARTITION BY location, section ORDER BY pos) - 1 AS BIGINT) AS idx, "desc", price
FROM sel""")
def q_board_lists(spark, sf):
    """The nested board's two lists, item by item."""
    nested = B.board(V.board_offers(spark, sf), V.locations(spark, sf), V.BOARD_DATE)
    lists = F.array(*[F.struct(F.lit(k).alias("section"), F.col(f"meals.{k}").alias("items")) for k in ("day", "week")])
    return nested.select("location", F.explode(lists).alias("l")) \
        .select("location", "l.section", F.posexplode("l.items").alias("idx", "m")) \
        .select("location", "section", F.col("idx").cast("bigint").alias("idx"), "m.desc", "m.price")
