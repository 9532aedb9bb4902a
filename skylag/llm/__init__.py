"""Training-data operators: extraction, deduplication, scoring, search and packing of large text tables."""
