"""Training-data operators: quality, near-duplicates, fingerprints, packing,
extraction, suffix dedup, mixing, language ID, chat formatting, similarity joins."""
