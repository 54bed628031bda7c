"""Sales warehouse on Spark: landing, staging, star schema, mart, checks and metrics."""
