"""Training-data operators: quality, extraction, deduplication, privacy, tokens, sharding, packing, archives."""
