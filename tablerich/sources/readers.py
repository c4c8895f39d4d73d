"""Sources: files, tables, queries, databases."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablerich.operators.inputs import parse_inline_rows
from tablerich.session import scratch_path
from tablerich.sources.split import csv_records, json_objects


def quote_name(name: str) -> str:
    """Backtick-quote each part of a possibly qualified table name."""
    parts = [p.strip() for p in (name or "").split(".")]
    if not all(parts):
        raise ValueError(f"invalid table name: {name!r}")
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def check_table_name(name: str) -> str:
    """Refuse anything but letters, digits, underscores and dots."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]*", name or ""):
        raise ValueError(f"invalid table name: {name!r}")
    return name


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, *, line_breaks: bool = False
) -> DataFrame:
    """CSV with a header; every column is text. Give ``columns`` to skip reading the header first.

    A file is split between tasks. With ``line_breaks`` quoted fields may hold line breaks, and files are read twice to find
    where records end (see ``split``); without it such a row raises.
    """
    options = {"header": True, "multiLine": line_breaks, "escape": '"'}
    if columns is None:
        columns = spark.read.csv(path, **options).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if line_breaks:
        read = F.from_csv("record", F.lit(schema.toDDL()), {"mode": "FAILFAST", "escape": '"'})
        # ``explode`` of one element: the record is parsed once and whole, whichever columns are asked for.
        return csv_records(spark, path).select(F.explode(F.array(read)).alias("row")).select("row.*")
    # All columns are parsed, whichever are asked for: otherwise a broken row could pass unseen.
    return spark.read.option("columnPruning", False).csv(path, schema=schema, mode="FAILFAST", **options)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, lines: bool | None = None
) -> DataFrame:
    """JSON lines, or files that each hold one array of objects; both are split between tasks. Bad JSON raises.

    ``lines=None`` reads lines, unless the first file begins with a line that opens an array and does not close
    it. ``lines=False`` refuses files that hold anything but an array.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if lines is None:
        lines = not _opens_array(spark, path)
    if lines:
        return reader.json(path, mode="FAILFAST")
    objects = scratch_path(spark, "objects")
    json_objects(spark, path).write.text(objects)
    return reader.json(objects, mode="FAILFAST")


def _opens_array(spark: SparkSession, path: str) -> bool:
    """Whether the first line with any text opens an array that goes on in the next."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    text = first[0].strip() if first else ""
    return text.startswith("[") and not text.endswith("]")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quote_name(name))


def read_source(spark: SparkSession, source: str, inputs: Sequence[str]) -> DataFrame:
    """A ``SELECT`` keeps all its columns; a table name keeps only the mapped input columns."""
    if source.lstrip()[:6].upper() == "SELECT":
        return spark.sql(source)
    return read_table(spark, source).select(*inputs)


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 32, **options: str,
) -> DataFrame:
    """A database table; give a numeric column and its bounds to read it in many tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=check_table_name(table), **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def read_inline(spark: SparkSession, text: str) -> tuple[DataFrame, list[dict[str, str]]]:
    """Rows a user typed as a JSON array of objects, and the source columns they imply."""
    rows = parse_inline_rows(spark.createDataFrame([(1, text)], "id int, text string"), "text", "id")
    wrong = rows.filter("error IS NOT NULL").orderBy("ordinal").first()
    if wrong:
        raise ValueError(wrong["error"])
    columns = [{"name": c, "description": f"The {c} field"} for c in json.loads(text)[0]]
    return rows.select(*[F.col("row")[c["name"]].alias(c["name"]) for c in columns]), columns


def source_columns(df: DataFrame) -> DataFrame:
    """``(ordinal, name, type, filled)``: the columns of a source and how many rows hold a value."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))


def detected_config(df: DataFrame, source: str, target: str, source_type: str, outputs: Sequence[dict]) -> dict:
    """A job config with every column of the source as an input."""
    return {
        "source": source,
        "target": target,
        "source_type": source_type,
        "source_columns": [{"name": c, "description": f"The {c} field"} for c in df.columns],
        "enriched_columns": list(outputs),
    }
