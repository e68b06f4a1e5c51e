"""Training-data operators: de-duplication, filtering, search, mixing and tokenising."""
