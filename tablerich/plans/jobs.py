"""Config-driven jobs: parse, preview, run, and run many."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablerich.operators import ledger
from tablerich.operators.enrich import typed_job
from tablerich.operators.inputs import check_columns, input_json
from tablerich.operators.naming import OutputColumn
from tablerich.operators.resolvers import Resolver
from tablerich.session import cut_lineage
from tablerich.sources import readers, writers

# Columns a job adds to say when and with which run a row came about.
STAMPS = ("batch_id", "insertion_timestamp")
SOURCE_TYPES = ("csv", "json", "table", "parquet", "jdbc")


class ConfigError(ValueError):
    """A job config that cannot be used."""


@dataclass(frozen=True)
class JobConfig:
    """A job. ``options`` are those of its reader (``lines``, ``line_breaks``, ``columns``, ``schema``, JDBC settings),
    and ``dropped``, a Parquet path for the rows that are left out.
    """

    source: str
    target: str
    source_type: str
    source_columns: list[OutputColumn]
    enriched_columns: list[OutputColumn]
    processor: str = "core-fast"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def inputs(self) -> dict[str, str]:
        return {c.name: c.name for c in self.source_columns}


def _columns(items, key: str) -> list[OutputColumn]:
    if not isinstance(items, list) or not items:
        raise ConfigError(f"{key} must be a list of columns")
    try:
        return [OutputColumn(i["name"], i["description"], i.get("type", "str")) for i in items]
    except (KeyError, TypeError, AttributeError) as exc:
        raise ConfigError(f"{key}: every column needs a name and a description") from exc


def parse_config(config: dict) -> JobConfig:
    if not isinstance(config, dict):
        raise ConfigError("a job config is a mapping")
    missing = [k for k in ("source", "target", "source_type", "source_columns", "enriched_columns") if k not in config]
    if missing:
        raise ConfigError(f"missing: {', '.join(missing)}")
    if config["source_type"] not in SOURCE_TYPES:
        raise ConfigError(f"source_type must be one of {', '.join(SOURCE_TYPES)}")
    return JobConfig(
        config["source"],
        config["target"],
        config["source_type"],
        _columns(config["source_columns"], "source_columns"),
        _columns(config["enriched_columns"], "enriched_columns"),
        config.get("processor", "core-fast"),
        config.get("options", {}),
    )


def load_config(path: str) -> JobConfig:
    """Read a YAML config."""
    import yaml

    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8") as f:
        try:
            return parse_config(yaml.safe_load(f))
        except yaml.YAMLError as exc:
            raise ConfigError(str(exc)) from exc


def _flag(options: Mapping, name: str, default: bool | None) -> bool | None:
    value = options.get(name, default)
    return value if value is None or isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "yes")


def read_job(spark: SparkSession, job: JobConfig) -> DataFrame:
    options = job.options
    match job.source_type:
        case "csv":
            return readers.read_csv(
                spark, job.source, options.get("columns"), line_breaks=bool(_flag(options, "line_breaks", False))
            )
        case "json":
            return readers.read_json(spark, job.source, options.get("schema"), _flag(options, "lines", None))
        case "parquet":
            return spark.read.parquet(job.source)
        case "jdbc":
            settings = {k: v for k, v in options.items() if k != "dropped"}
            return readers.read_jdbc(spark, table=job.source, **settings)
        case _:
            return readers.read_source(spark, job.source, list(job.inputs.values()))


def pick_resolver(job: JobConfig, resolver: Resolver | Mapping[str, Resolver]) -> Resolver:
    """The resolver itself, or the one registered for the processor of the job."""
    if not isinstance(resolver, Mapping):
        return resolver
    if job.processor not in resolver:
        raise ConfigError(f"unknown processor: {job.processor}")
    return resolver[job.processor]


def build_job(
    spark: SparkSession, job: JobConfig, resolver: Resolver | Mapping[str, Resolver], *, stamp: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Result and dropped rows of a job; lazy."""
    chosen = pick_resolver(job, resolver)
    source = read_job(spark, job)
    check_columns(source, job.inputs)
    return typed_job(source, job.inputs, job.enriched_columns, chosen, stamp=stamp)


def submit_job(spark: SparkSession, job: JobConfig, group_id: str) -> tuple[DataFrame, DataFrame]:
    """Queue the rows of a job without resolving them: ledger rows to append, and the group's summary."""
    source = read_job(spark, job)
    check_columns(source, job.inputs)
    runs = source.select(
        F.lit(group_id).alias("group_id"), F.expr("uuid()").alias("run_id"), input_json(job.inputs).alias("input")
    )
    return ledger.submit(runs)


def write_job(job: JobConfig, result: DataFrame) -> None:
    match job.source_type:
        case "csv":
            writers.write_csv(result, job.target)
        case "json":
            writers.write_json(result, job.target)
        case "parquet":
            result.write.mode("overwrite").parquet(job.target)
        case "jdbc":
            writers.append_jdbc(result, job.options["url"], job.target)
        case _:
            writers.replace_table(result, job.target)


def run_job(
    spark: SparkSession, config: dict | JobConfig, resolver: Resolver | Mapping[str, Resolver]
) -> DataFrame:
    """Run a job from a config and write its target; returns the dropped rows with the reason.

    They are also written as Parquet if the job has an option ``dropped``.
    """
    job = config if isinstance(config, JobConfig) else parse_config(config)
    result, dropped = build_job(spark, job, resolver)
    write_job(job, result)
    if "dropped" in job.options:
        dropped.write.mode("overwrite").parquet(job.options["dropped"])
        return spark.read.schema(dropped.schema).parquet(job.options["dropped"])
    return dropped


def dry_run(spark: SparkSession, job: JobConfig) -> DataFrame:
    """What a job would do: ``(source, target, processor, inputs, outputs, rows)``; nothing is resolved."""
    names = lambda columns: F.lit(", ".join(c.name for c in columns))
    return read_job(spark, job).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(job.source).alias("source"),
        F.lit(job.target).alias("target"),
        F.lit(job.processor).alias("processor"),
        names(job.source_columns).alias("inputs"),
        names(job.enriched_columns).alias("outputs"),
        "rows",
    )


def run_many(
    spark: SparkSession, configs: Sequence[tuple[str, dict]], resolver: Resolver | Mapping[str, Resolver]
) -> tuple[DataFrame | None, DataFrame]:
    """Run many jobs, one after the other; one that fails, at whatever step, does not stop the rest.

    Returns the rows of all good jobs, as stored, as one DataFrame with ``job`` (inputs and outputs as JSON text,
    because jobs differ in columns), and a status row per config: ``job, status, error, rows, dropped``.
    """
    parts: list[DataFrame] = []
    status: list[tuple[str, str, str | None, int, int]] = []
    for name, config in configs:
        try:
            job = parse_config(config)
            result, dropped = build_job(spark, job, resolver)
            stored = cut_lineage(result, "job")
            write_job(job, stored)
            left_out = cut_lineage(dropped, "dropped")
            if "dropped" in job.options:
                left_out.write.mode("overwrite").parquet(job.options["dropped"])
            status.append((name, "success", None, stored.count(), left_out.count()))
            row = F.to_json(F.struct(*[c for c in stored.columns if c not in STAMPS]))
            parts.append(stored.select(F.lit(name).alias("job"), row.alias("row")))
        except Exception as exc:
            status.append((name, "failed", str(exc).splitlines()[0], 0, 0))
    rows = None
    for part in parts:
        rows = part if rows is None else rows.unionByName(part)
    return rows, spark.createDataFrame(status, "job string, status string, error string, rows bigint, dropped bigint")


def totals(status: DataFrame) -> DataFrame:
    """How many jobs went well and how many failed: ``(jobs, succeeded, failed)``."""
    return status.agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
