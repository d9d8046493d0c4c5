"""Training-data operators: deduplication, sharding, packing, search, privacy, language, mixing, scoring and secrets."""
