"""Queries over the driver's tables, one or more for each operator, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import landed_queries, record_queries, report_queries, scalar_queries, silver_queries

_MODULES = [scalar_queries, silver_queries, report_queries, record_queries, landed_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
