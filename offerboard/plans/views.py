"""Driver tables seen as offers data.

The menus archive is not among the driver tables, so the board and the
offers store are exercised on ``events``: each event type is a location, each
event one meal (description = props, price = value), the event day its day key.
One event type publishes weekly standing offers, keyed by the ISO week label.
Everything is derived by Spark from the tables, so the work grows with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerboard.functions.dates import week_label
from offerboard.operators.quality import normalize_price
from offerboard.session import spread

BOARD_DATE = "2024-01-09"
WEEK_LOCATION = "purchase"


# tables whose per-row work is spread over the cores when a scan yields fewer
# tasks than cores (see session.spread), with the key to hash on
SPREAD_KEYS = {"pages": "page_id", "documents": "doc_id", "conversations": "conv_id", "events": "event_id",
               "lineitem": "l_orderkey", "orders": "o_orderkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in SPREAD_KEYS:
        df = spread(df, SPREAD_KEYS[name], spark)
    return df


def offers_from_events(events: DataFrame) -> DataFrame:
    """(location, file_week, key_kind, offer_key, pos, desc, price_raw, price, price_status)."""
    day = F.to_date("ts")
    is_week = F.col("event_type") == WEEK_LOCATION
    out = events.select(
        F.col("event_type").alias("location"),
        week_label(day, "iso").alias("file_week"),
        F.when(is_week, F.lit("week")).otherwise(F.lit("day")).alias("key_kind"),
        F.when(is_week, week_label(day, "iso")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("offer_key"),
        F.col("event_id").alias("pos"),
        F.col("props").alias("desc"),
        F.col("value").cast("string").alias("price_raw"))
    return normalize_price(out)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers_from_events(table(spark, sf_dir, "events"))


def board_offers(spark: SparkSession, sf_dir: str, date: str = BOARD_DATE) -> DataFrame:
    """Offers that can match the board of ``date``.

    The day key comes from events of that day; the week key from events of the
    ISO week that the board's label names, which around New Year is another
    week (the board's label of 2024-12-30 is ``2024-W01``). Both are plain
    ``ts`` ranges, so they reach the parquet scan (row-group skipping on
    time-clustered files) instead of a derived key tested row by row.
    """
    d = dt.date.fromisoformat(date)
    monday = d - dt.timedelta(days=d.weekday())
    ranges = [(monday, 7)]
    try:
        named = dt.date.fromisocalendar(monday.year, d.isocalendar().week, 1)
        ranges += [(named, 7)] if named != monday else []
    except ValueError:      # that year has no week of this number: no offer carries the label
        pass
    ev = table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType.simpleString()
    at = lambda day: F.lit(dt.datetime.combine(day, dt.time())).cast(ts_type)
    cond = F.lit(False)
    for start, days in ranges:
        cond = cond | ((F.col("ts") >= at(start)) & (F.col("ts") < at(start + dt.timedelta(days=days))))
    return offers_from_events(ev.filter(cond))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(location, name, link, details): one row per event type; 'error' has no details."""
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("location")).distinct()
    return types.select(
        "location", F.upper("location").alias("name"),
        F.concat(F.lit("https://"), F.col("location"), F.lit(".example.org/")).alias("link"),
        F.when(F.col("location") == "error", F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("open "), F.col("location")), F.lit("card payment"))).alias("details"))


MENU_CHUNK = 1000
MENU_TITLE = "Mittagsangebot"


def menu_documents(spark: SparkSession, sf_dir: str, html: bool = False) -> DataFrame:
    """Menu documents written from events: one per (event type, day, chunk of <= MENU_CHUNK events).

    Text form: a title line, the week's period (``dd.MM.yyyy - dd.MM.yyyy``),
    the weekday heading, then one ``<props> <price> €`` line per event in
    event order. HTML form: the period in a paragraph, an ``h4`` heading (the
    weekly event type gets the standing-offer heading) and a two-cell table
    row per event. Lines of a chunk are collected in event order; a chunk is
    bounded, however many events a day holds.
    -> (doc_id, location, text) or (page_id, location, html)
    """
    from offerboard.functions.dates import WEEKDAYS, week_monday, weekday_index
    from offerboard.functions.prices import format_price
    from offerboard.operators.menus import WEEK_SECTION_WORDS

    ev = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    monday = week_monday(day)
    period = F.concat(F.date_format(monday, "dd.MM.yyyy"), F.lit(" - "),
                      F.date_format(F.date_add(monday, 4), "dd.MM.yyyy"))
    weekday = F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), weekday_index(day) + 1)
    if html:
        heading = F.when(F.col("event_type") == WEEK_LOCATION, F.lit(WEEK_SECTION_WORDS[0])).otherwise(weekday)
        line = F.concat(F.lit("<tr><td>"), F.col("props"), F.lit("</td><td>"),
                        F.replace(F.col("value").cast("decimal(10,2)").cast("string"), F.lit(","), F.lit(".")),
                        F.lit(" €</td></tr>"))
    else:
        heading = weekday
        line = F.concat(F.col("props"), F.lit(" "), format_price(F.col("value")))
    keyed = ev.select(F.col("event_type").alias("location"), day.alias("day"),
                      F.floor(F.col("event_id") / MENU_CHUNK).cast("bigint").alias("part"),
                      F.col("event_id"), period.alias("period"), heading.alias("heading"), line.alias("line"))
    docs = keyed.groupBy("location", "day", "part").agg(
        F.first("period").alias("period"), F.first("heading").alias("heading"),
        F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: x["line"]), "\n" if not html else "")
    doc_key = F.concat_ws("/", "location", F.date_format("day", "yyyy-MM-dd"), F.col("part").cast("string"))
    if html:
        page = F.concat(F.lit("<div><p>Woche "), F.col("period"), F.lit("</p><h4>"), F.col("heading"),
                        F.lit("</h4><table>"), body, F.lit("</table></div>"))
        return docs.select(doc_key.alias("page_id"), "location", page.alias("html"))
    text = F.concat_ws("\n", F.lit(MENU_TITLE), F.col("period"), F.col("heading"), body)
    return docs.select(doc_key.alias("doc_id"), "location", text.alias("text"))
