"""Training-data operators: language mixtures, token counts, packing, search, quality, extraction, mixing, duplicates, PII."""
