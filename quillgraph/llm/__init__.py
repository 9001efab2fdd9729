"""Operators for training-data text; nothing outside this subpackage imports it."""

from quillgraph.llm.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
