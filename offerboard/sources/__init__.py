"""Scans (A1-A3, A8, A9) and sinks."""

from offerboard.sources.readers import (  # noqa: F401
    OFFERS_DOC_SCHEMA, scan_csv_table, scan_locations, scan_offers, scan_pages, scan_usage,
)
from offerboard.sources.sinks import (  # noqa: F401
    csv_sink, lines_sink, publish_bundle, write_artifacts, write_offers,
)
