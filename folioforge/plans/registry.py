"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.plans.bridge import tables, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: SQL of a query without the definitions of its tables, to be put over others.
RAW: dict[str, str] = {}


def query(name: str, *names: str, sql: str | None = None) -> Callable:
    """Register f(t) over the named bridge tables; sql may use these tables by name."""

    def add(f: Callable[[dict[str, DataFrame]], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: f(tables(spark, sf_dir, *names))
        if sql:
            RAW[name] = sql.strip()
            with_ = with_clause(*names)
            ORACLES[name] = f"{with_},\n{sql.strip()[5:]}" if sql.strip()[:5].upper() == "WITH " else f"{with_}\n{sql.strip()}"
        return f

    return add


def base_query(name: str, sql: str | None = None) -> Callable:
    """Register f(spark, sf_dir) over the base tables."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql.strip()
        return f

    return add
