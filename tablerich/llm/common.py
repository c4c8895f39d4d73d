"""What the operators of this subpackage share: the registry of their queries, reading, and small expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Characters between words, everywhere in this subpackage.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where SQL can."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without_spaces(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def fine(df: DataFrame, pieces: int = 1) -> DataFrame:
    """Deal rows out evenly, at least one task for each core and ``pieces`` for each shuffle partition."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * pieces
    return df.repartition(max(n, spark.sparkContext.defaultParallelism))
