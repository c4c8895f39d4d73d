"""Registry of queries: each with the SQL that must give the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from tablerich.plans import (  # noqa: F401
        queries_discovery,
        queries_enrich,
        queries_functions,
        queries_ledger,
        queries_monitor,
        queries_search,
        queries_sources,
        queries_streaming,
    )

    return QUERIES, ORACLE
