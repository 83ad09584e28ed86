"""Readers: landed Parquet bars and coin lists, landed API responses."""
