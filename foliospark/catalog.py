"""All queries of the core, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import chart_queries, document_queries, field_queries, layout_queries, nested_queries, routing_queries, table_queries, text_queries, word_queries

MODULES = [text_queries, layout_queries, field_queries, routing_queries, table_queries, word_queries, chart_queries, document_queries, nested_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
