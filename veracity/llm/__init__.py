"""Training-data operators: quality, chat, packing, WARC, mixing, near-duplicates, secrets, URLs."""
