"""Readers of stored files, pages, documents and SQL relations."""
