"""Every registered query and, where SQL can express it, its equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE[name] = sql


def load() -> None:
    """Import the modules that register queries."""
    from sparkloom.plans import assembly_queries, graph_queries, join_queries, markdown_queries, rule_queries, scalar_queries, table_queries, text_queries  # noqa: F401
