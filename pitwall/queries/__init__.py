"""Registered queries: each one a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its operator's name."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    from pitwall.queries import (  # noqa: F401
        basic, clusters, curves, entities, fitted, histories, samples, sliced)
