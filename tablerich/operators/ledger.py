"""Run ledger: one row per run, in groups; statuses, results and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablerich.operators.ordering import running_totals
from tablerich.operators.resolvers import NO_RESULT

# Statuses that end a run.
TERMINAL = ("completed", "failed", "cancelled")


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL)


def submit(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ledger rows for new runs ``(group_id, run_id, input)`` and the summary ``(group_id, num_runs)``."""
    queued = runs.select(
        "group_id",
        "run_id",
        "input",
        F.lit(None).cast("string").alias("output"),
        F.lit(None).cast("string").alias("error"),
        F.lit("queued").alias("status"),
        F.current_timestamp().alias("created_at"),
    )
    return queued, runs.groupBy("group_id").agg(F.count(F.lit(1)).alias("num_runs"))


def group_status(ledger: DataFrame) -> DataFrame:
    """``(group_id, num_runs, is_active, status_counts)``; the counts are JSON text in status order."""
    counts = ledger.groupBy("group_id", "status").agg(F.count(F.lit(1)).alias("n"))
    # After the first step a group has one row per status.
    pairs = F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n"))))
    return counts.groupBy("group_id").agg(
        F.sum("n").alias("num_runs"),
        F.bool_or(~is_terminal(F.col("status"))).alias("is_active"),
        F.to_json(pairs).alias("status_counts"),
    )


def collect_results(ledger: DataFrame) -> DataFrame:
    """Every run with its output or its error; neither means no result."""
    error = F.when(F.col("output").isNull(), F.coalesce("error", F.lit(NO_RESULT)))
    return ledger.select("group_id", "run_id", "input", "output", error.alias("error"))


def totals(ledger: DataFrame) -> DataFrame:
    results = collect_results(ledger)
    return results.groupBy("group_id").agg(
        F.count_if(F.col("error").isNull()).alias("completed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def classify(ledger: DataFrame, now: Column, timeout_seconds: int) -> DataFrame:
    """``outcome`` of each run: result, error, timeout or waiting; ``message`` explains an error."""
    late = now > F.col("created_at") + F.make_dt_interval(secs=F.lit(timeout_seconds))
    status = F.col("status")
    outcome = (
        F.when(status == "completed", "result")
        .when(status.isin("failed", "cancelled"), "error")
        .when(late, "timeout")
        .otherwise("waiting")
    )
    message = F.when(status.isin("failed", "cancelled"), F.coalesce("error", F.concat(F.lit("run "), status))).when(
        outcome == "timeout", F.lit(f"timed out after {timeout_seconds}s")
    )
    return ledger.select("group_id", "run_id", "status", outcome.alias("outcome"), message.alias("message"))


def latest(versions: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """The newest version of each run; an aggregate, so a run with many versions is reduced map-side.

    Of equal versions one that ends the run counts, if there is a ``status``; a result comes before a failure and a cancellation.
    """
    rest = [c for c in versions.columns if c != key and c not in version]
    ended = F.lit(0)
    if "status" in versions.columns:
        for place, status in enumerate(reversed(TERMINAL), 1):
            ended = F.when(F.col("status") == status, place).otherwise(ended)
    newest = F.max(F.struct(*version, ended.alias("_ended"), *rest)).alias("_v")
    return versions.groupBy(key).agg(newest).select(key, *[f"_v.{c}" for c in [*version, *rest]])


def cancel(current: DataFrame, wanted: DataFrame, version: str, at: Column | None = None) -> DataFrame:
    """New versions that cancel the wanted runs (``run_id``) which have not ended yet, to append to the ledger.

    ``current`` has the latest version of each run; the new one is ``at``, or the next number.
    """
    running = current.filter(~F.coalesce(is_terminal(F.col("status")), F.lit(False))).join(wanted.select("run_id"), "run_id", "left_semi")
    moved = (F.col(version) + 1 if at is None else at).cast(current.schema[version].dataType)
    return running.withColumns({version: moved, "status": F.lit("cancelled")}).select(*current.columns)


def progress(ledger: DataFrame, by: Sequence[str], step: Column) -> DataFrame:
    """Running ``completed`` and ``total`` per group after each time step.

    Runs are counted per group and step first; the running totals may then span many tasks per group.
    """
    counted = ledger.groupBy(*by, step.alias("step")).agg(
        F.count_if(F.col("status") == "completed").alias("completed"), F.count(F.lit(1)).alias("total")
    )
    return running_totals(counted, by, ["step"], ["completed", "total"])
