"""Training-data operators: tokens, media, near and exact duplicates, privacy, quality, mixing, secrets."""
