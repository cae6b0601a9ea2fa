"""DataFrame operators: cleaning, modelling, keys, checks, documents, rollups, merges."""
