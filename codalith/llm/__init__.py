"""Training-data operators: chat formatting, quality, deduplication, search, tokens, packing."""
