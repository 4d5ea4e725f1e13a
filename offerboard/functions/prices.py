"""Price expressions. Prices are DECIMAL(10,2), never double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(10,2)"

# Fixed value: a menu price such as "7,70 €", "6.90 €", "7,50€" or "1.250,00 €";
# never the tail of a longer number. The space may be a no-break space.
PRICE_PATTERN = r"(?<![0-9])(?<![0-9][.,])([0-9]{1,3}(?:\.[0-9]{3})+,[0-9]{2}|[0-9]+[.,][0-9]{2})[ \x{A0}]?€"
# Description is the text before the price; text after the euro sign is dropped.
DESC_PRICE_PATTERN = r"^(.*?)[\s\x{A0}]*" + PRICE_PATTERN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _to_decimal(text: Column) -> Column:
    # a dot before a comma separates thousands
    plain = F.when(text.contains(","), F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    return F.replace(plain, F.lit(","), F.lit(".")).try_cast(PRICE_TYPE)


def parse_price(col) -> Column:
    """First ``<digits>,<2 digits> €`` in the text as DECIMAL(10,2), else NULL."""
    raw = F.regexp_extract(_c(col), PRICE_PATTERN, 1)
    return F.when(raw != "", _to_decimal(raw)).cast(PRICE_TYPE)


def split_desc_price(col) -> tuple[Column, Column]:
    """(desc, price): desc is the trimmed text before the first price."""
    c = _c(col)
    has = c.rlike(PRICE_PATTERN)
    desc = F.when(has, F.trim(F.regexp_extract(c, DESC_PRICE_PATTERN, 1))).otherwise(F.trim(c))
    return desc, parse_price(c)


def normalize_price(raw_col) -> tuple[Column, Column]:
    """(price, price_status) from a raw JSON price text.

    absent, null or empty -> NULL / 'missing'; not a number -> NULL / 'invalid';
    zero -> 0.00 / 'zero'; otherwise the value / 'ok'.
    """
    raw = F.trim(_c(raw_col))
    price = F.nullif(raw, F.lit("")).try_cast(PRICE_TYPE)
    status = (
        F.when(raw.isNull() | (raw == ""), F.lit("missing"))
        .when(price.isNull(), F.lit("invalid"))
        .when(price == 0, F.lit("zero"))
        .otherwise(F.lit("ok"))
    )
    return price, status


def format_price(col, sep: str = ",") -> Column:
    """DECIMAL -> menu text ``7,70 €``."""
    return F.concat(F.replace(_c(col).cast(PRICE_TYPE).cast("string"), F.lit("."), F.lit(sep)), F.lit(" €"))
