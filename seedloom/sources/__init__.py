"""Readers for JSON Lines, schema documents, manifests and Parquet tables."""
