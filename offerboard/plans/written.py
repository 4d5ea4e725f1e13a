"""Queries over pages, files and runs that Spark writes from the driver's tables, each with its DuckDB oracle.

The driver's pages hold few of the structures that the page operators look
for. The pages written here hold each of them, with hits, misses and
fallbacks, so the answers are known from the rows they were written from.
Importing this module adds its queries to the catalog.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from offerboard.functions import html as H
from offerboard.operators import align as A
from offerboard.operators import board as B
from offerboard.operators import clean as K
from offerboard.operators import links as L
from offerboard.operators import menus as C
from offerboard.operators import nodes as N
from offerboard.operators.quality import normalize_price
from offerboard.operators.seen import SeenUrls
from offerboard.plans import views as V
from offerboard.plans.catalog import (
    _D, _SITE_BASE, LINKS_CTE, LOCATIONS_CTE, OFFERS_CTE, SELECTED_CTE, _iso, chosen_documents, register,
)
from offerboard.session import literal_table, shared_dir
from offerboard.sources import bundle, store, versions
from offerboard.sources import readers as R


def filled(template: str, **columns):
    """A string column: the template's ``{name}`` places filled from columns."""
    parts, rest = [], template
    while rest:
        at = min((i for i in (rest.find("{" + n + "}") for n in columns) if i >= 0), default=-1)
        if at != 0:
            parts.append(F.lit(rest if at < 0 else rest[:at]))
            rest = "" if at < 0 else rest[at:]
        else:
            name = rest[1:rest.index("}")]
            parts.append(columns[name])
            rest = rest[len(name) + 2:]
    return F.concat(*parts)


# ---------------------------------------------------------------- B11-B13, B18: container choice
BLOCK_PAGES = [
    # nested containers: the nearest one around the heading
    '<html><head><title>Plan {k}</title></head><body><div class="group/container outer"><p>aussen</p>'
    '<div class="x group/container"><p>vor</p><div><h2> Unser SPEISEPLAN </h2></div><p>Gericht {k}</p></div></div></body></html>',
    # no container: the heading's parent; no title either
    "<p>weg</p><section><h2>Speiseplan {k}</h2><p>Suppe</p></section><p>weg</p>",
    # no heading: the nearest classed block around the first innermost keyword
    '<title>T</title><div class="menu"><div><p>Mon<b>tag</b> {k}</p></div></div><div class="x">Dienstag</div>',
    # neither
    '<div class="menu"><h2>Karte</h2><p>{k}</p></div>',
    # heading and keyword: the heading's block comes first, though its container is only a parent
    '<div class="menu"><p>Dienstag</p></div><div class="no"><h2>Speiseplan</h2><p>{k}</p></div>',
    # the keyword's blocks have no class or no text, the heading names something else
    '<div><h2>Plan</h2><p>Freitag {k}</p></div><div class="menu"> </div>',
]


@register("written_chosen_blocks", """
WITH k AS (SELECT o_orderkey AS n, CAST(o_orderkey AS VARCHAR) AS k, o_orderkey % 6 AS kind FROM orders)
SELECT 'page/' || k AS page_id, CAST(CASE kind WHEN 0 THEN 6 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END AS INTEGER) AS pre,
  CASE kind WHEN 0 THEN 'container' WHEN 2 THEN 'keyword' ELSE 'parent' END AS strategy,
  CASE kind WHEN 0 THEN 'Plan ' || k WHEN 2 THEN 'Speiseplan - https://example.org/' || k ELSE 'Speiseplan' END AS title,
  CASE kind WHEN 0 THEN 'Plan ' || k || chr(10) || 'vor' || chr(10) || 'Unser SPEISEPLAN' || chr(10) || 'Gericht ' || k
            WHEN 1 THEN 'Speiseplan' || chr(10) || 'Speiseplan ' || k || chr(10) || 'Suppe'
            WHEN 2 THEN 'Speiseplan - https://example.org/' || k || chr(10) || 'Mon' || chr(10) || 'tag' || chr(10) || k
            ELSE 'Speiseplan' || chr(10) || 'Speiseplan' || chr(10) || k END AS text
FROM k WHERE kind IN (0, 1, 2, 4)""")
def q_written_chosen_blocks(spark, sf):
    """Nearest container, heading's parent, keyword block and no block, on pages with text keys."""
    k = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % len(BLOCK_PAGES)
    html = F.coalesce(*[F.when(kind == i, filled(p, k=k)) for i, p in enumerate(BLOCK_PAGES)])
    pages = V.table(spark, sf, "orders").select(F.concat(F.lit("page/"), k).alias("page_id"), html.alias("html"),
                                                F.concat(F.lit("https://example.org/"), k).alias("url"))
    doc = chosen_documents(spark, pages, ("h2", "speiseplan"), ("div", "group/container"),
                           ["montag", "dienstag", "mittwoch", "donnerstag", "freitag"])
    return doc.select("page_id", "pre", "strategy", "title", H.text_lines(F.col("doc")).alias("text"))


# ---------------------------------------------------------------- F4: two runs of one key, aligned
@register("aligned_runs", f"""
WITH {OFFERS_CTE},
a AS (SELECT location, offer_key, pos AS n, "desc" || ' #' || CAST(pos AS VARCHAR) AS d,
             CASE WHEN pos % 83 = 0 THEN CAST(1000 + CAST(pos AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) ELSE price END AS p,
             row_number() OVER (PARTITION BY location, offer_key ORDER BY pos DESC) > 10 AS early FROM offers),
s AS (SELECT *, CASE WHEN n % 97 = 0 THEN 'removed' WHEN n % 101 = 0 AND early THEN 'moved' WHEN n % 89 = 0 THEN 'price'
                     WHEN n % 83 = 0 THEN 'desc' ELSE 'same' END AS status FROM a)
SELECT location, offer_key, status, n AS a_pos, d AS a_desc, p AS a_price,
  CASE status WHEN 'removed' THEN NULL WHEN 'moved' THEN 2 * n + 1000000000000 ELSE 2 * n END AS b_pos,
  CASE status WHEN 'removed' THEN NULL WHEN 'desc' THEN d || ' neu' ELSE d END AS b_desc,
  CASE status WHEN 'removed' THEN NULL WHEN 'price' THEN CAST(coalesce(p, 0) + 1 AS DECIMAL(10,2)) ELSE p END AS b_price
FROM s
UNION ALL
SELECT location, offer_key, 'added', NULL, NULL, NULL, 2 * n + 1, 'neu ' || CAST(n AS VARCHAR), CAST(-1 AS DECIMAL(10,2))
FROM a WHERE n % 79 = 0""")
def q_aligned_runs(spark, sf):
    """a run against one with other positions, in which meals were inserted, removed, moved to the end and changed."""
    n = F.col("pos")
    early = F.row_number().over(Window.partitionBy("location", "offer_key").orderBy(F.desc("pos"))) > 10
    a = V.offers(spark, sf).select(
        "location", "offer_key", "pos", F.concat("desc", F.lit(" #"), n.cast("string")).alias("desc"),
        F.when(n % 83 == 0, (1000 + n.cast("decimal(18, 2)") / 100).cast("decimal(10, 2)")).otherwise(F.col("price")).alias("price"),
        early.alias("early"))
    moved = (n % 101 == 0) & F.col("early")
    b = a.where(n % 97 != 0).select(
        "location", "offer_key", F.when(moved, 2 * n + 1_000_000_000_000).otherwise(2 * n).alias("pos"),
        F.when((n % 83 == 0) & (n % 89 != 0) & ~moved, F.concat("desc", F.lit(" neu"))).otherwise(F.col("desc")).alias("desc"),
        F.when((n % 89 == 0) & ~moved, (F.coalesce("price", F.lit(0).cast("decimal(10, 2)")) + 1).cast("decimal(10, 2)"))
        .otherwise(F.col("price")).alias("price"))
    new = a.where(n % 79 == 0).select("location", "offer_key", (2 * n + 1).alias("pos"),
                                      F.concat(F.lit("neu "), n.cast("string")).alias("desc"),
                                      F.lit(-1).cast("decimal(10, 2)").alias("price"))
    return A.align_runs(a.drop("early"), b.unionByName(new))


# ---------------------------------------------------------------- A8: CSV tables with quoted line breaks
TABLE_KEYS = 4000        # order keys of one written table


@register("csv_tables", f"""
WITH o AS (SELECT *, o_orderkey // {TABLE_KEYS} AS t,
                  row_number() OVER (PARTITION BY o_orderkey // {TABLE_KEYS} ORDER BY o_orderkey) - 1 AS row FROM orders)
SELECT CAST(t AS BIGINT) AS t, CAST(row AS BIGINT) AS row, CAST(o_orderkey AS VARCHAR) || ', "' || o_orderstatus || '"' AS category,
  o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '"zwei' || chr(10) ELSE '' END AS monday, '' AS tuesday,
  CAST(o_custkey AS VARCHAR) AS friday
FROM o WHERE row NOT IN (4, 5)""")
def q_csv_tables(spark, sf):
    """Tables written with quoted commas, quotes and line breaks; file records 5 and 6 skipped, four columns read."""
    orders = V.table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    broken = F.when(F.col("o_orderkey") % 3 == 0, quoted(F.concat("o_orderpriority", F.lit('\n"zwei\n')))).otherwise(F.col("o_orderpriority"))
    record = F.concat_ws(",", key, quoted(F.concat(key, F.lit(', "'), "o_orderstatus", F.lit('"'))), broken, F.lit(""),
                         F.col("o_custkey").cast("string"))
    t = F.floor(F.col("o_orderkey") / TABLE_KEYS).cast("bigint")
    rows = orders.select(t.alias("t"), F.col("o_orderkey").alias("n"), record.alias("value"))
    heads = rows.select("t").distinct().select("t", F.lit(-1).cast("bigint").alias("n"), F.lit("Nr,Kategorie,Montag,Dienstag,Freitag").alias("value"))
    path = shared_dir(spark, "csv-tables")
    rows.unionByName(heads).repartition("t").sortWithinPartitions("t", "n").select("t", "value").write.partitionBy("t").text(path)
    cells = R.scan_csv_table(spark, path, skip_rows=[4, 5], glob="*.txt")
    return R.csv_table_columns(cells, ["category", "monday", "tuesday", "friday"], keep_cols=[1, 2, 3, 4]).select(
        F.regexp_extract("file", "/t=([0-9]+)/", 1).cast("bigint").alias("t"), "row", "category", "monday", "tuesday", "friday")


# ---------------------------------------------------------------- C16: thousands of tables transposed
@register("transposed_tables", """
WITH cells AS (SELECT l_orderkey, l_linenumber, unnest([0, 1, 2, 3]) AS row,
                      unnest([CAST(l_partkey AS VARCHAR), l_returnflag, CAST(l_suppkey AS VARCHAR),
                              CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linestatus END]) AS value FROM lineitem),
wide AS (SELECT l_orderkey, max(CASE WHEN l_linenumber % 3 = 0 THEN 3 ELSE 4 END) AS width FROM lineitem GROUP BY l_orderkey)
SELECT c.l_orderkey, CAST(c.row AS BIGINT) AS row, CAST(0 AS BIGINT) AS part, list(c.value ORDER BY c.l_linenumber, c.value) AS cells
FROM cells c JOIN wide w USING (l_orderkey) WHERE c.row < w.width GROUP BY c.l_orderkey, c.row""")
def q_transposed_tables(spark, sf):
    """One table an order, its lines as records of three or four cells, swapped."""
    cells = [F.col("l_partkey").cast("string"), F.col("l_returnflag"), F.col("l_suppkey").cast("string")]
    ragged = F.when(F.col("l_linenumber") % 3 == 0, F.array(*cells)).otherwise(F.array(*cells, F.col("l_linestatus")))
    tables = V.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("row"), ragged.alias("cells"))
    return C.transpose_tables(tables, ["l_orderkey"])


# ---------------------------------------------------------------- E1, E5: batches that commit
@register("seen_in_batches", f"""WITH {LINKS_CTE},
abs AS (SELECT CASE WHEN starts_with(url, 'http://') THEN 0 ELSE 1 END AS batch,
               CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links)
SELECT url, CAST(min(batch) AS INTEGER) AS batch FROM abs GROUP BY url""")
def q_seen_in_batches(spark, sf):
    """Http pages as a first batch, all pages as a second; every url with the batch that found it."""
    links = L.absolutize(L.extract_links(V.table(spark, sf, "pages")), L.site_base("url"), out="abs_url") \
        .select(F.col("url").alias("page"), F.col("abs_url").alias("url"))
    seen = SeenUrls(spark, shared_dir(spark, "seen"))
    first = seen.add(links.where(F.col("page").startswith("http://")), "run-0")
    second = seen.add(links, "run-1")
    return first.withColumn("batch", F.lit(0)).unionByName(second.withColumn("batch", F.lit(1)))


_RUN_WEEK = f"CAST(week({_D}) AS INTEGER) % 2"


@register("versioned_offers", f"""
WITH e AS (SELECT event_type AS location, {_iso(_D)} AS file_week, event_id AS pos, props, {_RUN_WEEK} AS odd FROM events)
SELECT location, file_week, pos, CASE WHEN odd = 0 THEN 'r10' ELSE 'r9' END || ' ' || props AS "desc" FROM e
WHERE odd = 1 OR location <> 'error'""")
def q_versioned_offers(spark, sf):
    """Run r2 of all weeks, r10 of the even ones (which empties one location's), r9 late, r2 once more."""
    day = F.to_date("ts")
    even = F.weekofyear(day) % 2 == 0
    rows = V.offers(spark, sf).select("location", "file_week", "offer_key", "pos", "desc", "price_raw")
    days = V.table(spark, sf, "events").select(F.col("event_id").alias("pos"), even.alias("even"))
    rows = rows.join(days, "pos")
    run = lambda df, r: df.withColumn("run", F.lit(r)).withColumn("desc", F.concat(F.lit(r + " "), "desc")).drop("even")
    gone = F.col("location") == "error"
    emptied = rows.where("even").where(gone).select("location", "file_week").distinct()
    later = run(rows.where("even").where(~gone), "r10").unionByName(
        emptied.withColumn("run", F.lit("r10")), allowMissingColumns=True)
    path = shared_dir(spark, "versioned")
    for i, batch in enumerate((run(rows, "r2"), later, run(rows, "r9"), run(rows, "r2"))):
        store.write_batch(normalize_price(batch), path, f"run-{i}")
        versions.commit(spark, path, f"run-{i}")
    return store.read_store(spark, path).select("location", "file_week", "pos", "desc")


# ---------------------------------------------------------------- A5, D10: the document in lines, rows in places
PART = 400               # positions of a line


@register("published_lines", f"""
WITH {OFFERS_CTE}, {LOCATIONS_CTE},
parts AS (SELECT location, offer_key, pos // {PART} AS part,
                 string_agg('{{"desc":' || to_json("desc") || ',"price":' || coalesce(CAST(price AS VARCHAR), 'null') || '}}', ',' ORDER BY pos) AS meals
          FROM offers GROUP BY ALL),
flagged AS (SELECT *, min(part) OVER k AS first, max(part) OVER k AS last, min(offer_key) OVER (PARTITION BY location) AS first_key
            FROM parts WINDOW k AS (PARTITION BY location, offer_key)),
lines AS (
  SELECT 0 AS section, NULL AS location, 0 AS kind, NULL AS offer_key, NULL AS part, '{{"locations":[' AS value
  UNION ALL SELECT 2, NULL, 0, NULL, NULL, ']}}'
  UNION ALL SELECT 1, location, 0, NULL, NULL, CASE WHEN location = (SELECT min(location) FROM locations) THEN '' ELSE ',' END || '{{"name":' || to_json(name)
    || ',"link":' || to_json(link) || ',"details":' || to_json(details) || ',"offers":{{' FROM locations
  UNION ALL SELECT 1, location, 2, NULL, NULL, '}}}}' FROM locations
  UNION ALL SELECT 1, location, 1, offer_key, part, CASE WHEN part > first THEN ',' ELSE CASE WHEN offer_key = first_key THEN '' ELSE ',' END
    || to_json(offer_key) || ':[' END || meals || CASE WHEN part = last THEN ']' ELSE '' END FROM flagged)
SELECT row_number() OVER (ORDER BY section, location, kind, offer_key NULLS FIRST, part NULLS FIRST) - 1 AS position, CAST(value AS VARCHAR) AS value FROM lines""")
def q_published_lines(spark, sf):
    """The published document's lines, each with its place in the document."""
    lines = bundle.bundle_lines(V.offers(spark, sf), V.locations(spark, sf), PART)
    return B.positioned(lines, bundle.ORDER).select("position", "value")


@register("board_positions", f"""
WITH {OFFERS_CTE}, {SELECTED_CTE}
SELECT row_number() OVER (ORDER BY location, section, pos) - 1 AS position, location, section, pos, "desc" FROM sel""")
def q_board_positions(spark, sf):
    """The day's and week's offers with their place in the display order."""
    rows = B.board_rows(V.board_offers(spark, sf), V.BOARD_DATE).where("row_kind = 'meal'")
    placed = B.positioned(rows, ["location", "section_rank", "row_rank", "pos"])
    return placed.select("position", "location", F.when(F.col("section_rank") == 0, "day").otherwise("week").alias("section"), "pos",
                         F.col("text").alias("desc"))


# ---------------------------------------------------------------- C22 to C6, C8, C11-C13, C18: rules that extraction reads
RULED_TEXT = """Karte {k}
08.01.2024 – 12.01.2024
jedes Gericht 7,90 €
Montag – Neujahr
Das Team wünscht allen ein gutes Jahr!
Heute kein separates Gericht
Dienstag
Schnitzel {k}er Art a,g
oder
Feiertagsbraten {k} 8,90 €
Suppe {k}
Mittwoch
Am Feiertag geschlossen
Donnerstag
alternativ
Ruhetag
Eintopf {k}er Art 2,g"""
RULED_HOSTS = ["a.example.org", "B.example.org", "shop.example.com", "none.example.net"]
SITE_RULES = [("example.org", True, True, None, None, None), ("example.com", None, False, False, ["Ruhetag"], ["oder", "alternativ"])]
SITE_OVERRIDES = [("b.example.org", 2, False)]


@register("ruled_menus", """
WITH rows(kind, day, pos, "desc", price) AS (VALUES
  (0, 8, NULL, NULL, NULL), (0, 9, 7, 'Schnitzel {k}er Art', 7.90), (0, 9, 9, 'Feiertagsbraten {k}', 8.90), (0, 9, 10, 'Suppe {k}', 7.90),
  (0, 10, NULL, NULL, NULL), (0, 11, 14, 'alternativ', 7.90), (0, 11, 15, 'Ruhetag', 7.90), (0, 11, 16, 'Eintopf {k}er Art', 7.90),
  (0, 12, NULL, NULL, NULL),
  (1, 9, 7, 'Schnitzel {k}er Art', 7.90), (1, 9, 9, 'Feiertagsbraten {k}', 8.90), (1, 11, 14, 'alternativ', 7.90), (1, 11, 15, 'Ruhetag', 7.90),
  (2, 8, 4, 'Das Team wünscht allen ein gutes Jahr!', NULL), (2, 8, 5, 'Heute kein separates Gericht', NULL),
  (2, 9, 7, 'Schnitzel {k}er Art a,g', NULL), (2, 9, 9, 'Feiertagsbraten {k}', 8.90), (2, 9, 10, 'Suppe {k}', NULL),
  (2, 10, 12, 'Am Feiertag geschlossen', NULL), (2, 11, 16, 'Eintopf {k}er Art 2,g', NULL),
  (3, 9, 7, 'Schnitzel {k}er Art a,g', 7.90), (3, 9, 9, 'Feiertagsbraten {k}', 8.90), (3, 9, 10, 'Suppe {k}', 7.90),
  (3, 11, 14, 'alternativ', 7.90), (3, 11, 15, 'Ruhetag', 7.90), (3, 11, 16, 'Eintopf {k}er Art 2,g', 7.90))
SELECT CAST(o_orderkey AS BIGINT) AS doc_id, '2024-01-' || lpad(CAST(r.day AS VARCHAR), 2, '0') AS offer_key, CAST(r.pos AS BIGINT) AS pos,
  replace(r."desc", '{k}', CAST(o_orderkey AS VARCHAR)) AS "desc", CAST(r.price AS DECIMAL(10,2)) AS price
FROM orders JOIN rows r ON r.kind = o_orderkey % 4""")
def q_ruled_menus(spark, sf):
    """C22 -> C6, C8, C11-C13, C18: layered rules by domain, resolved per page, read by the extraction of its text."""
    k = F.col("o_orderkey").cast("string")
    host = F.element_at(F.array(*[F.lit(h) for h in RULED_HOSTS]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    pages = V.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.concat(F.lit("https://"), host, F.lit("/menu")).alias("url"), filled(RULED_TEXT, k=k).alias("text"))
    lists = "array<string>"
    rules = literal_table(spark, SITE_RULES, [("host", "string"), ("footnotes", "boolean"), ("keep_empty", "boolean"),
                                              ("one_price", "boolean"), ("notices", lists), ("separators", lists)])
    overrides = literal_table(spark, SITE_OVERRIDES, [("host", "string"), ("max_meals", "int"), ("keep_empty", "boolean")])
    ruled = C.site_settings(pages, [rules, overrides])
    return C.extract_text_menu(ruled, "page_id", keep_empty_days=False, settings=tuple(C.MENU_SETTINGS)).drop("key_kind")


# ---------------------------------------------------------------- B15: cleaned from the node table
DIRTY = ('<!doctype html><?pi x?><html><head><title>T {k}</title><meta name="m"><link rel="r" href="l.css"><script>var a = "<p>";</script>'
         '<style>p > b {}</style></head><body onload="x()"><!-- no --><form action="/f"><label>L</label><input value="i"><select><option>o'
         '</select><button>B <b>b</b></button></form><a href="java\tscript:run()" class="c" title="t&quot;{k}">A &amp; <i>{k}</i></a>'
         '<object><param name="p"><p>in object</p></object><iframe src="i"><p>x</iframe><embed src="e"><frameset><frame></frameset>'
         '<marquee>run</marquee><madeup id="1">own <b>tag</b></madeup><img src="/{k}.png" alt="5 < 6" width="3"><br/>1 < {k}</body></html>')
CLEAN = ('T {k}<style>p > b {}</style><label>L</label><a href="" title="t&quot;{k}">A &amp; <i>{k}</i></a>run'
         'own <b>tag</b><img src="/{k}.png" alt="5 &lt; 6"><br>1 &lt; {k}')


@register("written_clean_pages", f"""
SELECT CAST(o_orderkey AS BIGINT) AS page_id, CASE WHEN o_orderkey % 3 = 0 THEN '<p>plain ' || CAST(o_orderkey AS VARCHAR) || '</p> tail'
  ELSE replace('{CLEAN.replace("'", "''")}', '{{k}}', CAST(o_orderkey AS VARCHAR)) END AS clean_html FROM orders""")
def q_written_clean_pages(spark, sf):
    """Pages that hold every element the cleaner kills, drops or keeps; a third of them hold none."""
    k = F.col("o_orderkey").cast("string")
    html = F.when(F.col("o_orderkey") % 3 == 0, filled("<p id='x'>plain {k}</p> tail", k=k)).otherwise(filled(DIRTY, k=k))
    pages = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    return K.clean_nodes(N.html_nodes(pages, text_tags=(), columns=K.COLUMNS))
