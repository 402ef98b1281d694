"""Operators for large-scale training text. Nothing outside this subpackage imports it."""

from .queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
