"""Training-data operators: cleaning, scoring, counting, deduplication, mixing, archives and encoding."""
