"""Column-level helpers: calendar keys, column lists, type policies."""
