"""Training-data operators: fingerprints, packing, tokenising, scoring, sharding, dedup."""
