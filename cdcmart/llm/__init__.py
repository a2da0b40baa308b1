"""Training-data operators: sharding, tokens, duplicates, filters, formatting, search."""
