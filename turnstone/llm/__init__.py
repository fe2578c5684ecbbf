"""Training-data operators: filters, scoring, duplicates, archives, tokens and chat trees."""
