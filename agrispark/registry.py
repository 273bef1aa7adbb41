"""Queries by name, each with the DuckDB SQL that its rows must equal (or none)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agrispark.fixtures import adapted, with_adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    """Register ``function(*adapted tables) -> DataFrame`` under ``name``."""

    def add(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: function(*(adapted(spark, sf_dir, t) for t in tables))
        if sql is not None:
            ORACLE_SQL[name] = with_adapters(sql)
        return function

    return add
