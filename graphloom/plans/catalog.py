"""All queries of the library, by name, and the SQL each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.plans import extract_queries, graph_queries, refresh_queries, structure_queries, text_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return graph_queries.QUERIES | structure_queries.QUERIES | text_queries.QUERIES | extract_queries.QUERIES | refresh_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return graph_queries.SQL | structure_queries.SQL | text_queries.SQL | extract_queries.SQL | refresh_queries.SQL
