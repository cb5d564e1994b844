"""Training-data operators: quality, language, duplicates, contamination, tokens, archives and chat examples."""
