"""Column expressions (all built-in Spark functions, so they stay in codegen)."""

from offerboard.functions.text import (  # noqa: F401
    ascii_fold, clean_desc, html_unescape, minify_ws, normalize_space, safe_name,
    starts_with_year, strip_footnotes, strip_ws, word_count,
)
from offerboard.functions.prices import format_price, normalize_price, parse_price, split_desc_price  # noqa: F401
from offerboard.functions.dates import (  # noqa: F401
    default_date, parse_period, week_label, week_monday, weekday_index,
)
