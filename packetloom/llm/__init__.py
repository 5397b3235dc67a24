"""Training-data operators: dedup, packing, tokenising, quality, privacy, search and sharding over text tables."""
