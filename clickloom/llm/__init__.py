"""Training-data operators: filters, deduplication, mixing, packing, archives, token files."""
