"""Training-data operators: cleaning, deduplication, scoring, tokenising, packing and vector search."""
