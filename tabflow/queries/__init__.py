"""Registered queries: each survey operator re-aimed at the star-schema tables,
with a DuckDB oracle SQL where the result is SQL-expressible."""

from tabflow.queries.registry import REGISTRY, all_queries, oracle_sqls

__all__ = ["REGISTRY", "all_queries", "oracle_sqls"]
