"""Training-data operators: formatting, tokenizing, near-duplicates, quality, sharding."""
