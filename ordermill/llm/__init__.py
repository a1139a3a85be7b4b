"""Training-data operators: extraction, fingerprints, dedup, quality, PII,
search, tokenization, packing and sharding, plus their registered queries."""
