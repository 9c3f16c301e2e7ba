"""Registered queries (``queries.REGISTRY``) and their DuckDB oracle SQL (``oracle.SQL``)."""
