"""Training-data operators: deduplication, extraction, scoring, filtering, mixing and token output."""
