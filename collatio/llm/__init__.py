"""Training-data operators: extraction, cleaning, deduplication, formatting and packing of text corpora."""
