"""Queries that exercise every operator over given tables, and their SQL equivalents."""
