"""Sinks: files, tables, reports and the cache of enriched rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablerich.session import cut_lineage
from tablerich.sources.readers import check_table_name, quote_name


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; a DataFrame without rows still writes the header. Nested values become JSON text."""
    nested = {f.name: F.to_json(f"`{f.name}`") for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")}
    df.withColumns(nested).write.csv(path, header=True, mode="overwrite", escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; fields that are null are written, so every row has every column."""
    df.write.json(path, mode="overwrite", ignoreNullFields=False)


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(quote_name(name))


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(quote_name(name))


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    settings = {"batchsize": "10000", **options}
    df.write.format("jdbc").options(url=url, dbtable=check_table_name(table), **settings).mode("append").save()


def result_table(df: DataFrame, name: str | None, *, replace: bool = False, view: str = "enriched") -> DataFrame:
    """Store a result under a name (an existing table raises unless ``replace``), or as a view."""
    if name is None:
        df.createOrReplaceTempView(view)
        return df.sparkSession.table(view)
    df.write.mode("overwrite" if replace else "errorifexists").saveAsTable(quote_name(name))
    return df.sparkSession.table(quote_name(name))


def write_reports(
    reports: DataFrame, path: str, *, key: str = "run_id", content: str = "content",
    is_text=None, force: bool = False, folders: bool = True,
) -> None:
    """Metadata of every report as JSON; text bodies apart, in one folder per report.

    ``is_text`` is a Column that says which reports are text; without it all are. For very many reports
    ``folders=False`` keeps the bodies as rows ``(key, content)`` instead.
    """
    mode = "overwrite" if force else "errorifexists"
    # Read by both writes, computed once.
    reports = cut_lineage(reports, "reports")
    text = F.lit(True) if is_text is None else is_text
    body = F.when(~text, F.col(content)).alias(content)
    rest = [c for c in reports.columns if c != content]
    reports.select(*rest, body).write.mode(mode).json(f"{path}/metadata")
    bodies = reports.filter(text).select(key, content).write.mode(mode)
    if folders:
        bodies.partitionBy(key).text(f"{path}/markdown")
    else:
        bodies.json(f"{path}/markdown")


def stamp_cache(df: DataFrame) -> DataFrame:
    """Rows as the cache keeps them, with the time they were enriched."""
    return df.withColumn("enriched_at", F.current_timestamp())


def append_cache(df: DataFrame, path: str) -> None:
    """Add freshly enriched rows to a Parquet cache."""
    stamp_cache(df).write.mode("append").parquet(path)
