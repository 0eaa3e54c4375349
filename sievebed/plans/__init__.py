"""Composed jobs, from raw documents and stored pages to loaded tables."""
