"""Training-data operators: scoring, de-duplication, quality, extraction, packing."""
