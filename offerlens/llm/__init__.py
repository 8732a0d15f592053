"""Training-data operators: extraction, de-duplication, scoring, mixing."""
