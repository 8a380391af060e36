"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


def joined(x: Column) -> Column:
    """An array as one string, so that engines compare it alike."""
    return F.array_join(x, "|")
