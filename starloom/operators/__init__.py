"""DataFrame-level operators: lookups, merges, checks, metrics."""
