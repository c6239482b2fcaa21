"""Training-data operators: packing, near-duplicates, scoring, tokens, extraction, search."""
