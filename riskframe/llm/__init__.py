"""Training-data operators: filters, extraction, scoring, dedup, mixing, search."""
