"""Catalog pages rendered from the given tables, the registered queries and their SQL."""
