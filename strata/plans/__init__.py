"""Composite steps (bronze/silver/gold) and the query registry."""
