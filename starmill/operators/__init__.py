"""DataFrame operators: cleaning, dimensions, facts, upserts, checks."""
