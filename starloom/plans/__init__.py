"""The warehouse models, from staging to the mart."""
