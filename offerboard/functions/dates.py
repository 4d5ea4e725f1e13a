"""Date expressions: week labels, periods, weekdays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# German weekday names, Monday first, and month names.
WEEKDAYS = ["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"]
MONTHS = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August",
          "September", "Oktober", "November", "Dezember"]

_MONTH_ALT = "|".join(MONTHS)
# "01. – 05. Januar 2024", "29. Januar – 02. Februar 2024"
_NAMED_PERIOD = (r"([0-9]{1,2})\.\s*(" + _MONTH_ALT + r")?\s*[-–]\s*([0-9]{1,2})\.\s*("
                 + _MONTH_ALT + r")\s+([0-9]{4})")
# "01.01.2024 - 05.01.2024"
_NUMERIC_PERIOD = r"([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})\s*[-–]\s*([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _month_index(name: Column) -> Column:
    m = F.create_map(*[x for i, n in enumerate(MONTHS) for x in (F.lit(n), F.lit(i + 1))])
    return F.element_at(m, name)


def week_monday(col) -> Column:
    return F.to_date(F.date_trunc("week", _c(col).cast("date")))


def week_label(col, style: str = "iso") -> Column:
    """``YYYY-Www`` for a date.

    ``iso``: ISO 8601 week-year and week. ``board``: the week number of the
    Monday on or before the date, with that Monday's calendar year, so
    2024-12-30 is ``2024-W01`` (ISO says ``2025-W01``).
    """
    d = _c(col).cast("date")
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    if style == "iso":
        # the ISO week-year is the calendar year of the week's Thursday
        year = F.year(F.date_add(week_monday(d), 3))
    elif style == "board":
        year = F.year(week_monday(d))
    else:
        raise ValueError(f"unknown week label style {style!r}")
    return F.concat(year.cast("string"), F.lit("-W"), week)


def weekday_index(col) -> Column:
    """0 for Monday ... 6 for Sunday."""
    return F.pmod(F.dayofweek(_c(col).cast("date")) + 5, 7)


def default_date() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def parse_period(col) -> Column:
    """Start DATE of a menu period heading, NULL when none is found."""
    c = _c(col)
    nd, nm, ny = (F.regexp_extract(c, _NUMERIC_PERIOD, i) for i in (1, 2, 3))
    numeric = F.try_to_date(F.concat_ws("-", ny, nm, nd), "y-M-d")
    d1 = F.regexp_extract(c, _NAMED_PERIOD, 1)
    m1 = F.nullif(F.regexp_extract(c, _NAMED_PERIOD, 2), F.lit(""))
    m2 = F.regexp_extract(c, _NAMED_PERIOD, 4)
    y2 = F.regexp_extract(c, _NAMED_PERIOD, 5)
    start_month = _month_index(F.coalesce(m1, m2))
    end_month = _month_index(m2)
    start_year = y2.try_cast("int") - F.when(start_month > end_month, 1).otherwise(0)
    named = F.try_to_date(F.concat_ws("-", start_year.cast("string"), start_month.cast("string"), d1), "y-M-d")
    # both forms need "<digit>." somewhere; a cheap test first spares the long patterns on other text
    return F.when(c.rlike(r"[0-9]\."), F.coalesce(F.when(nd != "", numeric), F.when(d1 != "", named)))
