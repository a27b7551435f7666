"""Named queries over the given tables, each with its plain-SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests only."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def load_all() -> None:
    """Import every module that registers queries."""
    from quarryline.plans import (  # noqa: F401
        queries_aggregate,
        queries_clean,
        queries_codes,
        queries_datasets,
        queries_dates,
        queries_join,
        queries_project,
        queries_quality,
        queries_read,
        queries_spatial,
        queries_stream,
        queries_text,
        queries_write,
    )
