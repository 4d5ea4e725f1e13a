"""Queries over archives, artifacts and states that Spark writes from the driver's tables, each with its oracle.

Each has rows that hit and rows that miss. Importing this module adds its
queries to the catalog.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from offerboard.functions.dates import week_label
from offerboard.operators import board as B
from offerboard.operators import incremental as E
from offerboard.operators import links as L
from offerboard.operators import menus as C
from offerboard.operators import nodes as N
from offerboard.operators.quality import normalize_price, usage_summary
from offerboard.plans import views as V
from offerboard.plans.catalog import _D, _SITE_BASE, LINKS_CTE, OFFERS_CTE, _iso, register
from offerboard.session import shared_dir
from offerboard.sources import readers as R
from offerboard.sources import sinks as S

_OFFER_DAY = f"strftime({_D}, '%Y-%m-%d')"


# ---------------------------------------------------------------- A1, A2, A9: JSON files
@register("archive_files", f"""
SELECT event_type AS location, {_iso(_D)} AS file_week, {_OFFER_DAY} AS run, {_OFFER_DAY} AS offer_key,
  row_number() OVER (PARTITION BY event_type, {_D} ORDER BY event_id) - 1 AS pos, props AS "desc", CAST(value AS DECIMAL(10,2)) AS price
FROM events WHERE event_type <> 'error'
UNION ALL SELECT DISTINCT event_type, {_iso(_D)}, {_OFFER_DAY}, {_OFFER_DAY}, NULL, NULL, NULL FROM events WHERE event_type = 'error' AND day({_D}) % 2 = 0""")
def q_archive_files(spark, sf):
    """A1: one JSON file a location and day, written and scanned; ``error`` days are empty lists or no JSON."""
    ev = V.table(spark, sf, "events")
    day = F.to_date("ts")
    key = F.date_format(day, "yyyy-MM-dd")
    meals = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "props", F.col("value").cast("decimal(10,2)").alias("price")))),
                                  lambda x: F.struct(x["props"].alias("desc"), x["price"].alias("price"))))
    docs = ev.groupBy(F.col("event_type").alias("location"), week_label(day, "iso").alias("file_week"), key.alias("run")).agg(meals.alias("m"))
    head = F.concat(F.lit('{"'), "run", F.lit('": '))
    value = F.when(F.col("location") != "error", F.concat(head, "m", F.lit("}"))) \
        .when(F.dayofmonth("run") % 2 == 0, F.concat(head, F.lit("[]}"))).otherwise(head)
    path = shared_dir(spark, "archive")
    docs.select("location", "file_week", "run", value.alias("value")).repartition("location", "file_week", "run") \
        .write.partitionBy("location", "file_week", "run").text(path)
    return normalize_price(R.scan_offers(spark, path, "*.txt")).select("location", "file_week", "run", "offer_key", "pos", "desc", "price")


@register("location_files", """
SELECT c_mktsegment AS location, CASE WHEN count(*) % 2 = 0 THEN NULL ELSE upper(c_mktsegment) END AS name,
  'https://x.org/' || CAST(min(c_custkey) AS VARCHAR) AS link,
  CASE WHEN c_mktsegment = 'BUILDING' THEN []::VARCHAR[] ELSE ['open', CAST(max(c_custkey) AS VARCHAR)] END AS details
FROM customer GROUP BY c_mktsegment""")
def q_location_files(spark, sf):
    """A2: one metadata document a location, with and without a name or details."""
    groups = V.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("location")).agg(
        F.count("*").alias("n"), F.min("c_custkey").cast("string").alias("low"), F.max("c_custkey").cast("string").alias("high"))
    details = F.when(F.col("location") != "BUILDING", F.array(F.lit("open"), "high"))
    doc = F.to_json(F.struct(F.when(F.col("n") % 2 == 1, F.upper("location")).alias("name"), F.concat(F.lit("https://x.org/"), "low").alias("link"),
                             details.alias("details")))
    path = shared_dir(spark, "locations")
    groups.select("location", doc.alias("value")).repartition("location").write.partitionBy("location").text(path)
    return R.scan_locations(spark, path, "*.txt")


@register("usage_files", """
WITH u AS (SELECT o_orderstatus AS location, CASE WHEN o_orderstatus = 'F' THEN 'one' ELSE 'two' END AS provider,
                  lower(left(o_orderpriority, 1)) AS model, count(*) AS p, count(DISTINCT o_custkey) AS c FROM orders GROUP BY ALL)
SELECT location, provider, 'm-' || model AS model, 1 AS n_records, p AS prompt_tokens, c AS completion_tokens,
  p + c + CASE WHEN model = '1' THEN 1 ELSE 0 END AS total_tokens, model <> '1' AS totals_ok FROM u""")
def q_usage_files(spark, sf):
    """Usage records in JSON files; the totals of one model are wrong."""
    model = F.lower(F.substring("o_orderpriority", 1, 1))
    u = V.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("location"), model.alias("m")).agg(
        F.count("*").alias("p"), F.count_distinct("o_custkey").alias("c"))
    doc = F.to_json(F.struct(F.col("p").alias("prompt_tokens"), F.col("c").alias("completion_tokens"),
                             (F.col("p") + F.col("c") + F.when(F.col("m") == "1", 1).otherwise(0)).alias("total_tokens")))
    path = shared_dir(spark, "usage")
    u.select("location", F.when(F.col("location") == "F", "one").otherwise("two").alias("provider"), F.concat(F.lit("m-"), "m").alias("model"),
             doc.alias("value")).repartition("location", "provider", "model").write.partitionBy("location", "provider", "model").text(path)
    return usage_summary(R.scan_usage(spark, path, "*.txt"))


# ---------------------------------------------------------------- A6, A7: artifacts and lines
@register("latest_bodies", """
SELECT CAST(o_orderkey AS VARCHAR) AS artifact_name, 'raw' AS kind,
  CASE WHEN o_orderkey % 3 = 0 THEN 'r10 ' WHEN o_orderkey % 3 = 1 THEN 'r9 ' ELSE 'r2 ' END || o_orderpriority AS body FROM orders""")
def q_latest_bodies(spark, sf):
    """Three runs of artifacts, the later ones of a part only; each name's latest body, r10 after r9."""
    orders = V.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("artifact_name"), F.lit("raw").alias("kind"),
                                                 "o_orderkey", "o_orderpriority")
    path = shared_dir(spark, "artifacts")
    for run, keep in (("r2", F.lit(True)), ("r10", F.col("o_orderkey") % 3 == 0), ("r9", F.col("o_orderkey") % 3 != 2), ("r2", F.lit(True))):
        S.write_artifacts(orders.where(keep).select("artifact_name", "kind", F.concat(F.lit(run + " "), "o_orderpriority").alias("body")), path, run)
    return S.latest_artifacts(spark.read.parquet(path))


@register("line_texts", """SELECT conv_id AS doc_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""")
def q_line_texts(spark, sf):
    """All lines of a document as one record, written as JSON and read back."""
    lines = V.table(spark, sf, "conversations").where("text is not null") \
        .select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), F.col("text").alias("line"))
    path = shared_dir(spark, "lines")
    S.lines_sink(lines, path)
    kind = lines.schema["doc_id"].dataType.simpleString()
    return spark.read.schema(f"doc_id {kind}, text string").json(path)


# ---------------------------------------------------------------- B21-B23, E3: modified times
_META = """k AS (SELECT o_orderkey AS n, CAST(o_orderkey AS VARCHAR) AS k, o_orderkey % 5 AS kind,
  '2024-01-' || lpad(CAST(1 + o_orderkey % 28 AS VARCHAR), 2, '0') || 'T08:00:00' AS t FROM orders),
m AS (SELECT *, CASE kind WHEN 0 THEN t || '+00:00' WHEN 1 THEN t || '+01:00' WHEN 2 THEN 'gestern ' || k WHEN 3 THEN '' ELSE '2024 ' || k END AS v,
  CASE kind WHEN 0 THEN CAST(t AS TIMESTAMP) WHEN 1 THEN CAST(t AS TIMESTAMP) - INTERVAL 1 HOUR END AS ts FROM k)"""


def _meta_pages(spark, sf):
    """Pages with a time in either attribute order, a word, none, and a year that is no time; five hosts."""
    k, n = F.col("o_orderkey").cast("string"), F.col("o_orderkey")
    time = F.concat(F.lit("2024-01-"), F.lpad((1 + n % 28).cast("string"), 2, "0"), F.lit("T08:00:00"))
    html = (F.when(n % 5 == 0, F.concat(F.lit('<meta property="article:modified_time" content="'), time, F.lit('+00:00"><p>x</p>')))
            .when(n % 5 == 1, F.concat(F.lit('<meta content="'), time, F.lit('+01:00" property="article:modified_time">')))
            .when(n % 5 == 2, F.concat(F.lit('<meta property="article:modified_time" content="gestern '), k, F.lit('">')))
            .when(n % 5 == 3, F.lit('<meta property="og:title" content="2024-01-01T00:00:00Z">'))
            .otherwise(F.concat(F.lit('<meta property="article:modified_time" content="2024 '), k, F.lit('">'))))
    return V.table(spark, sf, "orders").select(n.alias("page_id"), F.concat(F.lit("https://h"), (n % 7).cast("string"), F.lit(".org/"), k).alias("url"),
                                               html.alias("html"))


@register("written_meta", f"""WITH {_META}
SELECT n AS page_id, v AS meta_value, kind IN (0, 1, 4) AS meta_valid, ts AS meta_ts, CASE WHEN ts IS NULL THEN 'fallback' ELSE 'ok' END AS status,
  coalesce(CAST(ts AS DATE), DATE '2023-12-31') AS day FROM m""")
def q_written_meta(spark, sf):
    """Meta values that are times, words, missing and years only; a failed step takes its fallback."""
    meta = L.page_meta(_meta_pages(spark, sf))
    days = meta.withColumn("own", F.to_date("meta_ts")).withColumn("usual", F.to_date(F.lit("2023-12-31")))
    return L.with_status(days, "own", "usual", "day").select(
        "page_id", "meta_value", "meta_valid", F.col("meta_ts").cast("timestamp_ntz").alias("meta_ts"), "status", "day")


@register("changed_sites", f"""WITH {_META}
SELECT n AS page_id, 'h' || CAST(n % 7 AS VARCHAR) || '.org' AS location, ts AS modified FROM m
WHERE ts IS NOT NULL AND (n % 7 > 4 OR ts > TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(n % 7 AS INTEGER)))""")
def q_changed_sites(spark, sf):
    """E3 for pages: newer than their site's mark, on sites with and without one."""
    state = spark.range(5).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".org")).alias("location"),
                                  F.timestamp_add("DAY", F.col("id").cast("int"), F.to_timestamp(F.lit("2024-01-10 00:00:00"))).alias("high_water"))
    return E.changed_sites(_meta_pages(spark, sf), state).select("page_id", "location", F.col("modified").cast("timestamp_ntz").alias("modified"))


# ---------------------------------------------------------------- E2, D1, D9
@register("links_without_state", f"WITH {LINKS_CTE} SELECT page_id, pos, CASE WHEN starts_with(href, 'http') THEN href ELSE {_SITE_BASE} || href END AS url FROM links")
def q_links_without_state(spark, sf):
    """Without a state every link is new."""
    links = L.absolutize(L.extract_links(V.table(spark, sf, "pages")), L.site_base("url"), out="abs_url")
    return E.new_links(links.select("page_id", "pos", F.col("abs_url").alias("url")), None)


@register("empty_selection", f"WITH {OFFERS_CTE} SELECT location, 0 AS n FROM offers WHERE false")
def q_empty_selection(spark, sf):
    """No date selects nothing, on every form of the board."""
    offers, places = V.board_offers(spark, sf), V.locations(spark, sf)
    forms = [B.board(offers, places, None), B.board_rows(offers, None), B.board_summary(offers, places, None)]
    out = forms[0].select("location")
    for f in forms[1:]:
        out = out.unionByName(f.select("location"))
    return out.select("location", F.lit(0).alias("n"))


@register("todays_offers", f"""WITH {OFFERS_CTE}, t AS (SELECT *, CASE WHEN pos % 3 = 0 THEN strftime(current_date, '%Y-%m-%d') ELSE offer_key END AS k FROM offers)
SELECT location, k AS offer_key, pos FROM t WHERE k = strftime(current_date, '%Y-%m-%d')""")
def q_todays_offers(spark, sf):
    """The default date is the day the query runs; a third of the offers are dated today."""
    day, _ = B.board_keys(None)
    offers = V.offers(spark, sf).withColumn("offer_key", F.when(F.col("pos") % 3 == 0, day).otherwise(F.col("offer_key")))
    return offers.where(F.col("offer_key") == day).select("location", "offer_key", "pos")


# ---------------------------------------------------------------- C2, C6, C13, C20, C9 rejects
_MENU_KIND = "o_orderkey % 4"


def _menus(spark, sf):
    """Texts with a period and a price in the head, a price below the first heading, no price, no period."""
    k, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    head = F.when(kind != 3, "08.01.2024 - 12.01.2024\n").otherwise("Karte\n")
    price = F.when(kind == 0, "alles 6,50 €\n").when(kind == 3, "alles 5,00 €\n").otherwise("")
    text = F.concat(F.lit("Menü\n"), head, price, F.lit("Dienstag\nSuppe "), k, F.lit("\n"), F.when(kind == 1, "Braten 9,80 €\n").otherwise(""),
                    F.lit("Mittwoch\n"))
    return V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


@register("document_heads", f"""
SELECT CAST(o_orderkey AS BIGINT) AS doc_id, CASE WHEN {_MENU_KIND} <> 3 THEN DATE '2024-01-08' END AS week_start,
  CAST(CASE {_MENU_KIND} WHEN 0 THEN 6.50 WHEN 3 THEN 5.00 END AS DECIMAL(10,2)) AS doc_price FROM orders""")
def q_document_heads(spark, sf):
    """Period and price of a text's head; prices below the first heading are no document price."""
    docs = _menus(spark, sf)
    lines = C.to_lines(docs)
    first = lines.filter(C.heading_word("line").isNotNull()).groupBy("doc_id").agg(F.min("pos").alias("first_heading_pos"))
    heads = lines.join(first, "doc_id", "left")
    return docs.select("doc_id").join(C.document_period(lines), "doc_id", "left").join(C.document_price(heads), "doc_id", "left")


@register("menu_maps", f"""
WITH d(day, nr) AS (VALUES ('2024-01-08', 0), ('2024-01-09', 1), ('2024-01-10', 2), ('2024-01-11', 3), ('2024-01-12', 4))
SELECT CAST(o_orderkey AS BIGINT) AS doc_id, d.day AS offer_key, CASE WHEN nr <> 1 THEN 0 WHEN {_MENU_KIND} = 1 THEN 2 ELSE 1 END AS n_meals,
  CASE WHEN nr = 1 THEN 'Suppe ' || CAST(o_orderkey AS VARCHAR) END AS first_desc, nr = 1 AS kept FROM orders, d WHERE {_MENU_KIND} <> 3""")
def q_menu_maps(spark, sf):
    """Each text as a map of days to meals, empty days included, and the days that stay without them."""
    rows = C.extract_text_menu(_menus(spark, sf))
    maps = C.offers_document(C.nest_offers(rows).drop("part"))
    days = maps.select("doc_id", F.explode("offers").alias("offer_key", "meals"))
    kept = C.drop_empty_days(rows).select("doc_id", "offer_key").distinct().withColumn("kept", F.lit(True))
    return days.join(kept, ["doc_id", "offer_key"], "left").select(
        "doc_id", "offer_key", F.size("meals").alias("n_meals"), F.get("meals", F.lit(0))["desc"].alias("first_desc"),
        F.coalesce("kept", F.lit(False)).alias("kept"))


@register("html_menu_rejects", """
SELECT CAST(o_orderkey AS BIGINT) AS doc_id, 'Sonstiges' AS section, CASE WHEN o_orderkey % 3 = 1 THEN 'no period' ELSE 'no weekday' END AS reason
FROM orders WHERE o_orderkey % 3 <> 2
UNION ALL SELECT CAST(o_orderkey AS BIGINT), 'Montag', 'no period' FROM orders WHERE o_orderkey % 3 = 1""")
def q_html_menu_rejects(spark, sf):
    """Table rows under no weekday, rows of pages without a period; pages without such rows."""
    n = F.col("o_orderkey")
    period = F.when(n % 3 == 1, "").otherwise("<p>08.01.2024 - 12.01.2024</p>")
    other = F.when(n % 3 == 2, "").otherwise("<h4>Sonstiges</h4><table><tr><td>B</td><td>2,00 €</td></tr></table>")
    html = F.concat(period, F.lit("<h4>Montag</h4><table><tr><td>A</td><td>1,00 €</td></tr><tr><td></td><td></td></tr></table>"), other)
    pages = V.table(spark, sf, "orders").select(n.alias("page_id"), html.alias("html"))
    return C.html_menu_rejects(N.html_nodes(pages, columns=C.HTML_MENU_COLUMNS)).select("doc_id", "section", "reason")
