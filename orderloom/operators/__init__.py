"""Relational building blocks: deduplication, integrity checks, upsert, ranking, numbering."""
