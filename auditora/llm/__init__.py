"""Training-data operators: packing, deduplication, language ID, mixing, media, search."""
