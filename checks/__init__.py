"""Registered queries, their SQL, and the raw layer derived from the test tables."""
