"""Board query (section D): what is on offer at each location on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from offerboard.functions.dates import default_date, week_label
from offerboard.functions.prices import PRICE_TYPE
from offerboard.session import materialize

# Section labels shown when a location has both kinds of offers.
DAY_LABEL = "Tagesangebot"
WEEK_LABEL = "Wochenangebot"


TODAY = "today"


def board_keys(date: str | None, style: str = "board") -> tuple[Column, Column]:
    """(day key, week key) for a date; ``"today"`` is the current date (D1), D2 the week label."""
    d = default_date() if date in (None, TODAY) else F.lit(date)
    return d, week_label(F.to_date(d), style)


def day_offers(offers: DataFrame, date: str) -> DataFrame:
    """D3: exact day-key match (a literal filter, pushed into the scan / partition pruning)."""
    return offers.filter(F.col("offer_key") == F.lit(date))


def week_offers(offers: DataFrame, date: str, style: str = "board") -> DataFrame:
    """Exact week-key match."""
    return offers.filter(F.col("offer_key") == week_label(F.to_date(F.lit(date)), style))


def _selected(offers: DataFrame, date: str | None, style: str) -> DataFrame:
    day_key, week_key = board_keys(date, style)
    sel = offers.filter(F.col("offer_key").isin(day_key, week_key) & F.col("pos").isNotNull())
    if date is None:            # D9: no date selected -> nothing (use TODAY for the current date)
        sel = sel.filter(F.lit(False))
    return sel.withColumn("section", F.when(F.col("offer_key") == day_key, F.lit("day")).otherwise(F.lit("week")))


def details_label(col="details") -> Column:
    """Details joined by ', ', NULL when there are none."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.size(c) > 0, F.array_join(c, ", "))


def board_summary(offers: DataFrame, locations: DataFrame, date: str | None, style: str = "board",
                  loc: str = "location") -> DataFrame:
    """D5-D7 without the lists: every location with its day/week meal counts and labels.

    Counts are a partial (map-side) aggregate per location; locations without
    offers keep zero counts through the left join.
    """
    counts = _selected(offers, date, style).groupBy(loc).agg(
        F.count(F.when(F.col("section") == "day", 1)).alias("n_day"),
        F.count(F.when(F.col("section") == "week", 1)).alias("n_week"))
    out = locations.join(counts, loc, "left").select(
        loc, "name", "link", details_label("details").alias("details_label"),
        F.coalesce("n_day", F.lit(0)).cast("bigint").alias("n_day"),
        F.coalesce("n_week", F.lit(0)).cast("bigint").alias("n_week"))
    if date is None:
        out = out.filter(F.lit(False))
    return out.withColumn("has_offers", (F.col("n_day") > 0) | (F.col("n_week") > 0))


def board(offers: DataFrame, locations: DataFrame, date: str | None, style: str = "board",
          loc: str = "location") -> DataFrame:
    """Every location with ``meals: {day: [...], week: [...]}``, empty lists when nothing matches.

    Lists are per location and date (a menu day/week), collected map-side and
    ordered by position afterwards.
    """
    meal = F.struct(F.col("pos").alias("pos"), F.col("desc").alias("desc"), F.col("price").cast(PRICE_TYPE).alias("price"))
    strip = lambda a: F.transform(F.array_sort(a), lambda m: F.struct(m["desc"].alias("desc"), m["price"].alias("price")))
    lists = _selected(offers, date, style).groupBy(loc).agg(
        strip(F.collect_list(F.when(F.col("section") == "day", meal))).alias("day"),
        strip(F.collect_list(F.when(F.col("section") == "week", meal))).alias("week"))
    empty = F.array().cast("array<struct<desc:string,price:decimal(10,2)>>")
    out = locations.join(lists, loc, "left").select(
        loc, "name", "link", "details",
        F.struct(F.coalesce("day", empty).alias("day"), F.coalesce("week", empty).alias("week")).alias("meals"))
    return out.filter(F.lit(False)) if date is None else out


def has_offers(board_df: DataFrame) -> DataFrame:
    """D7 on the nested board."""
    return board_df.withColumn("has_offers", (F.size("meals.day") > 0) | (F.size("meals.week") > 0))


def board_rows(offers: DataFrame, date: str | None, style: str = "board", loc: str = "location") -> DataFrame:
    """D8 + D10: flat display rows, day before week, labels only when both lists are non-empty.

    Output: (location, section_rank, row_rank, pos, row_kind, text, price);
    sorting by (location, section_rank, row_rank, pos) gives the display order.
    The label rows come from a per-location count, the meal rows stream
    through untouched, so no list is ever materialised.
    """
    sel = _selected(offers, date, style)
    rank = F.when(F.col("section") == "day", F.lit(0)).otherwise(F.lit(1))
    meals = sel.select(loc, rank.alias("section_rank"), F.lit(1).alias("row_rank"), F.col("pos").cast("bigint").alias("pos"),
                       F.lit("meal").alias("row_kind"), F.col("desc").alias("text"),
                       F.col("price").cast(PRICE_TYPE).alias("price"))
    both = sel.groupBy(loc).agg(F.count(F.when(F.col("section") == "day", 1)).alias("nd"),
                                F.count(F.when(F.col("section") == "week", 1)).alias("nw")) \
        .filter((F.col("nd") > 0) & (F.col("nw") > 0))
    labels = both.select(loc, F.explode(F.array(
        F.struct(F.lit(0).alias("section_rank"), F.lit(DAY_LABEL).alias("text")),
        F.struct(F.lit(1).alias("section_rank"), F.lit(WEEK_LABEL).alias("text")))).alias("l")) \
        .select(loc, F.col("l.section_rank").alias("section_rank"), F.lit(0).alias("row_rank"),
                F.lit(None).cast("bigint").alias("pos"), F.lit("label").alias("row_kind"),
                F.col("l.text").alias("text"), F.lit(None).cast(PRICE_TYPE).alias("price"))
    return meals.unionByName(labels)


def ordered_board_rows(rows: DataFrame, loc: str = "location") -> DataFrame:
    """The display order as an explicit sort."""
    return rows.orderBy(loc, "section_rank", "row_rank", "pos")


def positioned(df: DataFrame, order, out: str = "position") -> DataFrame:
    """D10 for other readers: every row with its place, from 0, in the order of ``order``, without one sorting task.

    Rows are partitioned by ranges and sorted within them, then written once,
    with their range and place in it, since ranges are drawn from a sample and
    would not come out alike twice. The ranges' counts, one row each, give the
    places before them. Rows that ``order`` does not tell apart take some order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_range", F.spark_partition_id())
                         .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "positions")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(before, placed["_range"] == before["_r"]).select(*df.columns, (F.col("_before") + F.col("_place")).alias(out))
