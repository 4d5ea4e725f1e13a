"""Menu extraction (section C): text, HTML tables and week tables -> long offer rows.

Long offer rows are ``(doc_id, offer_key, key_kind, pos, desc, price)``; an
empty day is one row with NULL ``pos``. Every step is a DataFrame expression
or a window/aggregate bounded by one document (whole texts, never prefixes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from offerboard.functions.dates import WEEKDAYS, parse_period, week_label, week_monday
from offerboard.functions.prices import PRICE_PATTERN, PRICE_TYPE, parse_price, split_desc_price
from offerboard.functions.text import clean_desc, normalize_space, strip_footnotes, strip_ws
from offerboard.session import materialize

# Words of lines that announce a closed day instead of a meal (whole
# words, so a Feiertagsbraten is none), words that separate alternatives, and
# section names whose meals hold for the whole week.
NOTICE_PATTERNS = ["wünsch(e|en|t)", "kein separates", "Feiertag(s|e|en|es)?"]
SEPARATOR_WORDS = ["oder"]
WEEK_SECTION_WORDS = ["täglich im Angebot", "Wochenangebot"]

_WEEKDAY_ALT = "|".join(WEEKDAYS)
# A heading is a weekday alone, or followed by a dash and a word that is not a weekday
# ("Montag – Neujahr" is one, "Montag – Freitag von 12 – 14 Uhr" is not).
_HEADING = r"^(" + _WEEKDAY_ALT + r")(?:\s*[-–:,]\s*(.*))?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep=()) -> DataFrame:
    """(doc_id, pos, line, kept columns) for every line of every text, line trimmed."""
    # trimmed inside the array, so later predicates read one computed value per line
    lines = F.transform(F.split(F.col(text_col), r"\r?\n"), strip_ws)
    # outer: otherwise the planner adds a filter that works out each list a second time, below any shuffle
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(lines).alias("pos", "line"), *keep).filter(F.col("pos").isNotNull()) \
        .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "line", *keep)


def heading_word(line, words=tuple(WEEKDAYS)) -> Column:
    """The heading word when the line is a section heading, else NULL."""
    alt = "|".join(words)
    pattern = r"^(" + alt + r")(?:\s*[-–:,]\s*(.*))?$"
    word = F.regexp_extract(_c(line), pattern, 1)
    tail = F.regexp_extract(_c(line), pattern, 2)
    tail_is_word = tail.rlike(r"^(" + alt + r")\b")
    return F.when((word != "") & ~tail_is_word, word)


def assign_sections(lines: DataFrame, heading: Column, key: str = "doc_id", pos: str = "pos",
                    chunk: int | None = None, several: Column | None = None) -> DataFrame:
    """Each line gets the last heading at or above it (``section``) and that heading's pos.

    Without ``chunk`` the window is one group ordered by position (right for
    a single text, which is one input row). With ``chunk`` the carry-forward
    is a two-phase segmented scan, so a group holding a large share of all
    rows never lands in one task: a window per (group, pos div chunk), a
    small per-chunk table that carries the last heading of earlier chunks,
    and an equi-join that applies it. ``several`` may name the rows of groups
    that have more than one chunk, where that is known; others need no carry.
    """
    df = lines.withColumn("_h", heading)
    hpos = F.when(F.col("_h").isNotNull(), F.col(pos))
    if chunk is None:
        w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (df.withColumn("is_heading", F.col("_h").isNotNull())
                .withColumn("section", F.last("_h", ignorenulls=True).over(w))
                .withColumn("section_pos", F.last(hpos, ignorenulls=True).over(w))
                .drop("_h"))
    df = df.withColumn("_chunk", F.floor(F.col(pos) / chunk).cast("bigint"))
    w = Window.partitionBy(key, "_chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (df.withColumn("_ls", F.last("_h", ignorenulls=True).over(w))
             .withColumn("_lp", F.last(hpos, ignorenulls=True).over(w)))
    found = F.when(F.col("_h").isNotNull(), F.struct(F.col("_h").alias("h"), F.col(pos).alias("p")))
    chunks = (df if several is None else df.filter(several)).groupBy(key, "_chunk") \
        .agg(F.max_by(found, F.when(F.col("_h").isNotNull(), F.col(pos))).alias("_e"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.withColumn("_c", F.last("_e", ignorenulls=True).over(before)).filter(F.col("_c").isNotNull()) \
        .select(F.col(key).alias("_ck"), F.col("_chunk").alias("_cc"), "_c")
    # null-safe: a line without a key or position belongs to the group of such lines
    return (local.join(carry, F.col(key).eqNullSafe(F.col("_ck")) & F.col("_chunk").eqNullSafe(F.col("_cc")), "left")
            .withColumn("is_heading", F.col("_h").isNotNull())
            .withColumn("section", F.coalesce("_ls", F.col("_c.h")))
            .withColumn("section_pos", F.coalesce("_lp", F.col("_c.p")))
            .drop("_h", "_chunk", "_ls", "_lp", "_c", "_ck", "_cc"))


def _notice(text: Column, pattern) -> Column:
    """Whether the text holds the pattern as whole words."""
    edge = lambda p: F.concat(F.lit(r"(^|[^\p{L}])("), p, F.lit(r")([^\p{L}]|$)"))
    if isinstance(pattern, str):
        return text.rlike(r"(^|[^\p{L}])(" + pattern + r")([^\p{L}]|$)")
    return F.exists(pattern, lambda p: F.regexp_like(text, edge(p)))


def flag_notices(df: DataFrame, col: str = "line", patterns=tuple(NOTICE_PATTERNS), price: Column | None = None) -> DataFrame:
    """C11: ``is_notice`` when a text without a price holds a notice pattern as whole words.

    ``patterns`` is a list of patterns or the name of a column that holds one
    for each row (NULL: the usual list); ``price`` is the row's price where it
    stands elsewhere than in the text.
    """
    usual = _notice(_c(col), "|".join(NOTICE_PATTERNS if isinstance(patterns, str) else patterns)) if patterns else F.lit(False)
    if isinstance(patterns, str):
        usual = F.when(F.col(patterns).isNull(), usual).otherwise(_notice(_c(col), F.col(patterns)))
    own = parse_price(_c(col)) if price is None else price
    return df.withColumn("is_notice", F.coalesce(usual, F.lit(False)) & own.isNull())


def split_alternatives(lines: DataFrame, col: str = "line", words=tuple(SEPARATOR_WORDS)) -> DataFrame:
    """Separator lines (``oder``) are removed; the meals around them stay in order.

    ``words`` is a list or the name of a column that holds one for each row (NULL: the usual list).
    """
    if isinstance(words, str):
        usual = F.array(*[F.lit(w) for w in SEPARATOR_WORDS])
        hit = F.exists(F.coalesce(F.col(words), usual), lambda w: F.lower(w) == F.lower(_c(col)))
    else:
        hit = F.lower(_c(col)).isin([w.lower() for w in words])
    return lines.filter(~F.coalesce(hit, F.lit(False)))


def document_period(lines: DataFrame, key: str = "doc_id", pos: str = "pos", line: str = "line") -> DataFrame:
    """(doc_id, week_start): first period heading of a document, moved to its Monday."""
    return (lines.withColumn("_p", parse_period(F.col(line))).filter(F.col("_p").isNotNull())
            .groupBy(key).agg(F.min_by("_p", pos).alias("_start"))
            .select(key, week_monday(F.col("_start")).alias("week_start")))


def document_price(lines: DataFrame, key: str = "doc_id", pos: str = "pos", line: str = "line",
                   before: str | None = "first_heading_pos") -> DataFrame:
    """(doc_id, doc_price): first price in the head lines (above the first heading)."""
    df = lines.withColumn("_price", parse_price(F.col(line))).filter(F.col("_price").isNotNull())
    if before and before in lines.columns:
        df = df.filter(F.col(before).isNull() | (F.col(pos) < F.col(before)))
    return df.groupBy(key).agg(F.min_by("_price", pos).alias("doc_price"))


def weekday_to_date(df: DataFrame, monday: str = "week_start", section: str = "section",
                    out: str = "day") -> DataFrame:
    """C4: section weekday + Monday -> date (NULL for a section that is no weekday)."""
    idx = F.create_map(*[x for i, w in enumerate(WEEKDAYS) for x in (F.lit(w), F.lit(i))])
    return df.withColumn(out, F.date_add(F.col(monday), F.element_at(idx, F.col(section))))


def route_week_offers(df: DataFrame, section: str = "section", day: str = "day", monday: str = "week_start",
                      words=tuple(WEEK_SECTION_WORDS)) -> DataFrame:
    """Sections of standing offers go under the ISO week key, others under the day."""
    is_week = F.coalesce(F.col(section).isin(list(words)), F.lit(False))
    return (df.withColumn("key_kind", F.when(is_week, F.lit("week")).otherwise(F.lit("day")))
            .withColumn("offer_key", F.when(is_week, week_label(F.col(monday), "iso"))
                        .otherwise(F.date_format(F.col(day), "yyyy-MM-dd"))))


def fill_weekdays(meals: DataFrame, weeks: DataFrame, key: str = "doc_id", monday: str = "week_start",
                  n_days: int = 5, keep=()) -> DataFrame:
    """Every Monday..Friday key exists; a day without meals is one row with NULL pos (and the weeks' ``keep``)."""
    spine = weeks.select(key, *keep, F.explode_outer(F.sequence(F.col(monday), F.date_add(F.col(monday), n_days - 1)))
                         .alias("_d")).filter(F.col("_d").isNotNull()).select(key, *keep, F.lit("day").alias("key_kind"),
                                              F.date_format("_d", "yyyy-MM-dd").alias("offer_key"))
    present = meals.select(key, "key_kind", "offer_key").distinct()
    missing = spine.join(present, [key, "key_kind", "offer_key"], "left_anti")
    empty = missing.select(key, "offer_key", "key_kind", F.lit(None).cast("bigint").alias("pos"),
                           F.lit(None).cast("string").alias("desc"), F.lit(None).cast(PRICE_TYPE).alias("price"), *keep)
    return meals.select(key, "offer_key", "key_kind", "pos", "desc", "price", *keep).unionByName(empty)


def drop_empty_days(offers: DataFrame) -> DataFrame:
    """Days without meals are not output."""
    return offers.filter(F.col("pos").isNotNull())


def cap_per_section(df: DataFrame, n: int | Column, key: str = "doc_id", section_pos: str = "section_pos",
                    pos: str = "pos") -> DataFrame:
    """Rule 'a weekday is followed by n meals': later lines of a section are not meals (n NULL: no such rule)."""
    w = Window.partitionBy(key, section_pos).orderBy(pos)
    n = n if isinstance(n, Column) else F.lit(n)
    return df.withColumn("_k", F.row_number().over(w)).filter(n.isNull() | (F.col("_k") <= n)).drop("_k")


# a site's rules that the text extraction reads, each a typed column
MENU_SETTINGS = {"run_date": "date", "max_meals": "int", "all_week": "boolean", "keep_empty": "boolean", "footnotes": "boolean",
                 "one_price": "boolean", "notices": "array<string>", "separators": "array<string>"}
LINES_A_CHUNK = 10_000


def extract_text_menu(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      max_meals: int | None = None, keep_empty_days: bool = True,
                      footnotes: bool = False, settings=(), chunk: int = LINES_A_CHUNK) -> DataFrame:
    """Text menu -> long offer rows.

    ``settings`` names columns of ``docs`` that hold a site's rules
    (``site_settings``), each winning over the argument or the usual value
    where not NULL: ``run_date`` (the week of a text without a readable
    period), ``max_meals`` (lines of a section that are meals; NULL: all),
    ``all_week`` (every meal goes under the week key; a priced line needs no
    heading), ``keep_empty`` (days without meals are output), ``footnotes``
    (code lists at a meal's end go), ``one_price`` (a price in the head holds
    for meals without one; usual), ``notices`` and ``separators`` (what is no
    meal, instead of the usual patterns and words). Texts without a period and
    without a run date come out of ``text_menu_rejects``.

    Head lines (above the first weekday heading) carry the period (C2) and a
    price valid for all meals (C6); they are read within the text's row. A
    weekday heading opens a section (C3), carried over chunks of lines, so a
    text of millions of lines is the work of many tasks; notices (C11) and
    separators (C18) are not meals; each meal takes its own price or the
    document price.
    """
    unknown = set(settings) - set(MENU_SETTINGS)
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    settings = [c for c in settings if c in docs.columns]      # a known one that the texts do not have is not set
    rule = {c: F.col(c) if c in settings else F.lit(None).cast(t) for c, t in MENU_SETTINGS.items()}
    all_week = F.coalesce(rule["all_week"], F.lit(False))
    read = F.transform(F.split(F.col(text_col), r"\r?\n"), lambda x: F.struct(strip_ws(x).alias("line"), heading_word(strip_ws(x)).alias("h")))
    texts = docs.select(F.col(id_col).alias("doc_id"), read.alias("_l"), F.size(F.split(F.col(text_col), r"\r?\n")).alias("_lines"), *settings)
    first_heading = F.array_position(F.transform("_l", lambda x: x["h"].isNotNull()), True)
    head = F.when(first_heading > 0, F.slice("_l", F.lit(1), (first_heading - 1).cast("int"))).otherwise(F.col("_l"))
    first = lambda f: F.get(F.filter(F.transform("_head", lambda x: f(x["line"])), lambda v: v.isNotNull()), F.lit(0))
    texts = (texts.withColumn("_head", head).withColumn("_start", first(parse_period)).withColumn("doc_price", first(parse_price))
             .withColumn("week_start", week_monday(F.coalesce(F.col("_start"), rule["run_date"]))).drop("_head", "_start"))
    # outer: otherwise the planner adds a filter that reads each text a second time, below any shuffle
    lines = texts.select("doc_id", "week_start", "doc_price", "_lines", *settings, F.posexplode_outer("_l").alias("pos", "_x")) \
        .filter(F.col("pos").isNotNull()).select("doc_id", "week_start", "doc_price", "_lines", *settings, F.col("pos").cast("bigint").alias("pos"), "_x.line", F.col("_x.h").alias("_hw"))
    lines = assign_sections(lines, F.col("_hw"), chunk=chunk, several=F.col("_lines") > chunk).drop("_hw", "_lines")
    # "Montag: Erbsensuppe 3,50 €": a heading whose tail carries a price is also that day's first meal
    tail = F.regexp_extract(F.col("line"), _HEADING, 2)
    lines = lines.withColumn("line", F.when(F.col("is_heading") & tail.rlike(PRICE_PATTERN), tail)
                             .otherwise(F.col("line"))) \
        .withColumn("_meal_heading", F.col("is_heading") & F.col("line").rlike(PRICE_PATTERN))
    flagged = flag_notices(lines, patterns="notices" if "notices" in settings else tuple(NOTICE_PATTERNS))
    meals = split_alternatives(flagged.filter(
        (F.col("section").isNotNull() | (all_week & F.col("line").rlike(PRICE_PATTERN)))
        & (~F.col("is_heading") | F.col("_meal_heading")) & ~F.col("is_notice")
        & (F.col("line") != "") & F.col("week_start").isNotNull()),
        words="separators" if "separators" in settings else tuple(SEPARATOR_WORDS))
    if max_meals is not None or "max_meals" in settings:
        meals = cap_per_section(meals, F.coalesce(rule["max_meals"], F.lit(max_meals).cast("int")))
    desc, row_price = split_desc_price(F.col("line"))
    desc = clean_desc(desc)
    if footnotes or "footnotes" in settings:
        desc = F.when(F.coalesce(rule["footnotes"], F.lit(footnotes)), strip_footnotes(desc)).otherwise(desc)
    shared = F.when(F.coalesce(rule["one_price"], F.lit(True)), F.col("doc_price"))
    meals = (meals.withColumn("desc", desc)
             .withColumn("price", F.coalesce(row_price, shared).cast(PRICE_TYPE)))
    meals = route_week_offers(weekday_to_date(meals))
    if "all_week" in settings:
        meals = (meals.withColumn("key_kind", F.when(all_week, F.lit("week")).otherwise(F.col("key_kind")))
                 .withColumn("offer_key", F.when(all_week, week_label(F.col("week_start"), "iso")).otherwise(F.col("offer_key"))))
    out = meals.select("doc_id", "offer_key", "key_kind", "pos", "desc", "price")
    if not keep_empty_days and "keep_empty" not in settings:
        return out
    weeks = texts.select("doc_id", F.when(F.coalesce(rule["keep_empty"], F.lit(keep_empty_days)), F.col("week_start")).alias("week_start")).distinct()
    # read twice, as output and as the days that have meals
    return fill_weekdays(materialize(out, "menu-meals"), weeks)


def text_menu_rejects(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_date: str | None = None) -> DataFrame:
    """(doc_id, reason) of the texts that ``extract_text_menu`` cannot date: no period above the first heading.

    ``run_date`` names a column whose date stands in for the period. A NULL
    text is a reject too. No shuffle: the test runs within each text's lines.
    """
    lines = F.transform(F.split(F.col(text_col), r"\r?\n"), strip_ws)
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                         (F.col(run_date) if run_date else F.lit(None)).cast("date").alias("_run"),
                         F.transform(lines, lambda x: F.struct(heading_word(x).isNotNull().alias("h"),
                                                               parse_period(x).isNotNull().alias("p"))).alias("_l"))
    # the first line that is a heading or holds a period must be the latter
    first = F.try_element_at(F.filter("_l", lambda x: x["h"] | x["p"]), F.lit(1))
    bad = F.col("_text").isNull() | (F.col("_run").isNull() & ~F.coalesce(first["p"] & ~first["h"], F.lit(False)))
    return marked.filter(bad).select("doc_id", F.when(F.col("_text").isNull(), F.lit("no text"))
                                     .otherwise(F.lit("no period")).alias("reason"))


# columns of the node table that HTML menus are read from
HTML_MENU_COLUMNS = ("pre", "parent_pre", "sib", "tag", "own_text", "string_value")


def table_pairs(nodes: DataFrame, heading_tag: str = "h4", cell_tags=("td", "th"), keep=()) -> DataFrame:
    """C9 (+ C2): HTML table rows -> (page_id, pos, section, week_start, desc_cell, price_cell, page columns of ``keep``).

    Headings, cells and elements whose own text holds a period matter; their
    texts are read before the shuffle, the other nodes and texts stay behind.
    One window over what is left of each page, in document order, gives every
    cell the last heading above it and the page's first period; the row pivot
    then groups cells by their row, which the page partitioning already
    clusters, so it is shuffled once.
    """
    w = Window.partitionBy("page_id").orderBy("pre")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    text = normalize_space(F.col("string_value"))
    # "Dienstag, 02.01." is the section Dienstag
    named = F.coalesce(heading_word(text), text)
    is_head, is_cell = F.col("tag") == heading_tag, F.col("tag").isin(list(cell_tags))
    # no period without a digit and a dot; most elements have neither
    period = F.when(F.col("own_text").rlike(r"[0-9]\."), parse_period(normalize_space(F.col("own_text"))))
    read = nodes.filter(is_cell | is_head | period.isNotNull()).select(
        "page_id", "pre", "parent_pre", "sib", *keep, is_cell.alias("_cell"), F.when(is_cell, text).alias("_text"),
        F.when(is_head, named).alias("_heading"), period.alias("_period"))
    marked = (read.withColumn("section", F.last("_heading", ignorenulls=True).over(upto))
              .withColumn("_start", F.first("_period", ignorenulls=True).over(whole)))
    cells = marked.filter(F.col("_cell"))
    rows = cells.groupBy("page_id", F.col("parent_pre").alias("pre")).agg(
        *[F.first(k).alias(k) for k in keep], F.first("section").alias("section"), F.first("_start").alias("_start"),
        F.max(F.when(F.col("sib") == 0, F.col("_text"))).alias("desc_cell"),
        F.max(F.when(F.col("sib") == 1, F.col("_text"))).alias("price_cell"))
    return rows.select("page_id", F.col("pre").cast("bigint").alias("pos"), "section",
                       week_monday(F.col("_start")).alias("week_start"), "desc_cell", "price_cell", *keep)


def extract_html_menu(nodes: DataFrame, heading_tag: str = "h4", keep_empty_days: bool = True, keep=()) -> DataFrame:
    """HTML menu (day headings + two-cell table rows) -> long offer rows.

    Rows that cannot be dated come out of ``html_menu_rejects``. ``keep`` names
    columns that are the same on all nodes of a page (``html_nodes(keys=...)``)
    and stay on its rows.
    """
    pairs = table_pairs(nodes, heading_tag, keep=keep).withColumnRenamed("page_id", "doc_id")
    meals = flag_notices(pairs, "desc_cell", price=parse_price(F.col("price_cell"))).filter(
        (F.coalesce(F.col("desc_cell"), F.lit("")) != "") & ~F.col("is_notice") & F.col("week_start").isNotNull())
    meals = (meals.withColumn("desc", clean_desc(F.col("desc_cell")))
             .withColumn("price", parse_price(F.col("price_cell"))))
    meals = route_week_offers(weekday_to_date(meals)).filter(F.col("offer_key").isNotNull())
    out = meals.select("doc_id", "offer_key", "key_kind", "pos", "desc", "price", *keep)
    if not keep_empty_days:
        return out
    weeks = pairs.filter(F.col("week_start").isNotNull()).select("doc_id", "week_start", *keep).distinct()
    return fill_weekdays(out, weeks, keep=keep)


def html_menu_rejects(nodes: DataFrame, heading_tag: str = "h4") -> DataFrame:
    """(doc_id, pos, section, reason) of table rows with a text that ``extract_html_menu`` cannot date."""
    pairs = table_pairs(nodes, heading_tag).withColumnRenamed("page_id", "doc_id")
    rows = route_week_offers(weekday_to_date(flag_notices(pairs, "desc_cell", price=parse_price(F.col("price_cell"))).filter(
        (F.coalesce(F.col("desc_cell"), F.lit("")) != "") & ~F.col("is_notice"))))
    return rows.filter(F.col("offer_key").isNull()).select(
        "doc_id", "pos", "section", F.when(F.col("week_start").isNull(), F.lit("no period"))
        .otherwise(F.lit("no weekday")).alias("reason"))


def unpivot_week_table(df: DataFrame, id_cols, day_cols, day: str = "day", cell: str = "cell") -> DataFrame:
    """Category column(s) + one column per day -> (ids..., day, cell); empty cells skipped."""
    long = df.unpivot(list(id_cols), list(day_cols), day, cell)
    return long.filter(F.col(cell).isNotNull() & (strip_ws(F.col(cell).cast("string")) != ""))


def transpose_table(df: DataFrame, key_col: str, value_cols, keys=None, field: str = "field") -> DataFrame:
    """Rows become columns, for many tables at once.

    ``unpivot`` to (key, field, value), then ``pivot`` on the key. The output
    has one column per key; pass ``keys`` when known, otherwise Spark finds
    them and fails past ``spark.sql.pivotMaxValues`` rather than building an
    unbounded row.
    """
    long = df.select(F.col(key_col).cast("string").alias("_key"),
                     *[F.col(c).cast("string").alias(c) for c in value_cols]) \
        .unpivot(["_key"], list(value_cols), field, "_value")
    grouped = long.groupBy(field)
    piv = grouped.pivot("_key", [str(k) for k in keys]) if keys is not None else grouped.pivot("_key")
    return piv.agg(F.first("_value"))


def transpose_tables(tables: DataFrame, id_cols, row: str = "row", cells: str = "cells", max_slots: int = 10_000) -> DataFrame:
    """C16 for many tables at once: (ids..., row, part, cells) with rows and columns swapped.

    ``tables`` holds one record a row: the table's key columns, the record's
    number and its cells. Each cell moves to its swapped coordinates, then the
    cells of one new row are gathered in the order of the old records, in
    parts of at most ``max_slots`` record numbers, so a table of any length
    gives no unbounded row: the parts of a row, one after another, are the
    row. No pivot, hence no limit on columns, and a group is one part of one
    row, however many cells its table has. Short records count as filled up
    with NULL to the table's widest one; gaps in the numbers are closed;
    repeated numbers keep one slot each. A table without cells gives no rows.
    """
    ids = list(id_cols)
    records = tables.select(*ids, F.col(row).cast("bigint").alias("_slot"), F.coalesce(F.col(cells), F.array().cast("array<string>")).alias("_cells"))
    width = records.groupBy(*ids).agg(F.max(F.size("_cells")).alias("_width")) \
        .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(ids)], "_width")
    wide = records.join(width, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(ids)])
    full = F.concat("_cells", F.array_repeat(F.lit(None).cast("string"), F.col("_width") - F.size("_cells")))
    swapped = wide.select(*ids, "_slot", F.posexplode(full).alias("_row", "_value"))
    gathered = swapped.groupBy(*ids, F.col("_row").cast("bigint").alias("row"), F.floor(F.col("_slot") / max_slots).cast("bigint").alias("part")) \
        .agg(F.array_sort(F.collect_list(F.struct("_slot", "_value"))).alias("_v"))
    return gathered.select(*ids, "row", "part", F.transform("_v", lambda v: v["_value"]).alias("cells"))


def extract_week_table(table: DataFrame, id_col: str, category: str, day_cols, week_start: str = "week_start",
                       row: str = "row") -> DataFrame:
    """Week table (category column + one column per weekday, Monday first) -> long offer rows.

    C15 unpivot with empty cells skipped, C7 desc/price split per cell, C4 the
    column's weekday offset from the week's Monday, C13 days without meals
    simply produce no rows. ``pos`` orders a day's meals by table row.
    -> (doc_id, offer_key, key_kind, pos, category, desc, price)
    """
    offsets = F.create_map(*[x for i, c in enumerate(day_cols) for x in (F.lit(c), F.lit(i))])
    long = unpivot_week_table(table.select(id_col, row, category, week_start, *day_cols),
                              [id_col, row, category, week_start], list(day_cols), "_day", "_cell")
    desc, price = split_desc_price(F.col("_cell"))
    day = F.date_add(F.col(week_start), F.element_at(offsets, F.col("_day")))
    return long.select(F.col(id_col).alias("doc_id"), F.date_format(day, "yyyy-MM-dd").alias("offer_key"),
                       F.lit("day").alias("key_kind"), F.col(row).cast("bigint").alias("pos"), F.col(category),
                       clean_desc(desc).alias("desc"), price.alias("price"))


def dated_rows_to_meals(df: DataFrame, date_col: str, meal_cols, id_cols=()) -> DataFrame:
    """C17: one row per date with meal columns -> (ids..., day, slot, desc, price)."""
    long = unpivot_week_table(df, [*id_cols, date_col], meal_cols, "slot", "cell")
    desc, price = split_desc_price(F.col("cell"))
    return long.select(*id_cols, F.col(date_col).alias("day"), "slot", clean_desc(desc).alias("desc"),
                       price.alias("price"))


def side_dishes(df: DataFrame, main: str, sides, keep=()) -> DataFrame:
    """Main dish and each side dish become own meals, in order -> (keep..., idx, desc)."""
    arr = F.array(*[F.col(c) for c in [main, *sides]])
    return df.select(*keep, F.posexplode(arr).alias("idx", "desc")) \
        .filter(F.col("desc").isNotNull() & (strip_ws(F.col("desc")) != "")) \
        .withColumn("idx", F.col("idx").cast("bigint"))


def nest_offers(rows: DataFrame, keys=("doc_id", "offer_key"), max_items: int | None = None,
                pos: str = "pos") -> DataFrame:
    """C20: long rows -> ordered meal lists per key (empty day -> []).

    With ``max_items`` a key's meals are split into parts of at most that many
    positions (``part = pos div max_items``) so no list grows without bound;
    without it one list per key (fine for menus, a day holds a handful).
    """
    keys = list(keys)
    part = F.floor(F.col(pos) / max_items) if max_items else F.lit(0)
    meal = F.struct(F.col(pos).alias("pos"), F.col("desc").alias("desc"), F.col("price").cast(PRICE_TYPE).alias("price"))
    return (rows.withColumn("part", F.coalesce(part, F.lit(0)).cast("bigint"))
            .groupBy(*keys, "part")
            .agg(F.array_sort(F.collect_list(F.when(F.col(pos).isNotNull(), meal))).alias("_m"))
            .select(*keys, "part", F.transform("_m", lambda m: F.struct(m["desc"].alias("desc"), m["price"].alias("price")))
                    .alias("meals")))


def offers_document(nested: DataFrame, key: str = "doc_id") -> DataFrame:
    """Meal lists of one document -> ``MAP<offer_key, meals>`` (one row per document)."""
    return nested.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("offer_key", "meals"))).alias("offers"))


def as_of(date: str | None = None) -> Column:
    """The run date: a given ``YYYY-MM-DD`` or today."""
    return F.to_date(F.lit(date)) if date else F.current_date()


def current_weekdays(date: str | None = None) -> Column:
    """Monday..Friday of the run date's week."""
    m = week_monday(as_of(date))
    return F.sequence(m, F.date_add(m, 4))


def apply_site_rules(pages: DataFrame, rules: DataFrame, overrides: DataFrame | None = None,
                     url: str = "url", id_col: str = "page_id") -> DataFrame:
    """Attach per-site settings to pages; an override row wins column by column.

    ``rules``/``overrides`` are keyed by ``host``, a domain that also covers its
    sub-domains; a page takes the rule of its longest matching domain. Each
    page host is expanded into its dot suffixes and equi-joined with the rules
    (configuration, one row per site; the planner chooses the join); the
    longest match per page is a max aggregate. Pages without a rule keep NULL
    settings.
    """
    from offerboard.operators.links import host_of
    cols = [c for c in rules.columns if c != "host"]
    merged = rules
    if overrides is not None:
        o = overrides.select("host", *[F.col(c).alias(f"_o_{c}") for c in cols if c in overrides.columns])
        merged = rules.join(o, "host", "left").select(
            "host", *[F.coalesce(F.col(f"_o_{c}"), F.col(c)).alias(c) if c in overrides.columns else F.col(c)
                      for c in cols])
    labels = F.split(host_of(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keyed = pages.select(id_col, F.explode(suffixes).alias("host"))
    hits = keyed.join(merged, "host")
    best = hits.groupBy(id_col).agg(F.max_by(F.struct("host", *cols), F.length("host")).alias("_r"))
    return pages.join(best, id_col, "left").select(
        *pages.columns, F.col("_r.host").alias("rule_host"), *[F.col(f"_r.{c}").alias(c) for c in cols])


def site_settings(pages: DataFrame, layers, url: str = "url", id_col: str = "page_id", settings=None) -> DataFrame:
    """C22 for extraction: every page with its site's settings, one typed column each (``MENU_SETTINGS``).

    ``layers`` are tables keyed by ``host``, in rising precedence, each with
    any of the settings. A host's settings hold for its sub-domains too. Of
    the values that apply to a page, the one of the longest domain counts, and
    among those of one domain the one of the highest layer; a NULL is no value.
    Pages and rules meet in an equi-join on the page host's dot suffixes; one
    aggregate per page resolves all settings.
    """
    from offerboard.operators.links import host_of
    types = MENU_SETTINGS if settings is None else settings
    rules = None
    for level, layer in enumerate(layers):
        unknown = set(layer.columns) - {"host", *types}
        if unknown:
            raise ValueError(f"unknown settings {sorted(unknown)}")
        typed = layer.select("host", F.lit(level).alias("_level"), *[
            (F.col(c) if c in layer.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        rules = typed if rules is None else rules.unionByName(typed)
    labels = F.split(F.lower(host_of(url)), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hits = pages.select(id_col, F.explode_outer(suffixes).alias("host")).distinct().join(rules.withColumn("host", F.lower("host")), "host")
    rank = F.struct(F.length("host").alias("n"), F.col("_level").alias("l"))
    best = hits.groupBy(id_col).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in types])
    keyed = best.withColumnRenamed(id_col, "_id")
    return pages.join(keyed, pages[id_col].eqNullSafe(keyed["_id"]), "left").select(*[pages[c] for c in pages.columns], *[keyed[c] for c in types])
