"""Monitors: versioned registry, schedules, change detection, events and subscriptions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablerich.operators.inputs import moment
from tablerich.operators.ordering import with_previous

# Friendly names of frequencies.
FREQUENCY_PRESETS = {"hourly": "1h", "daily": "1d", "weekly": "1w", "every_two_weeks": "2w"}
# Monitor types and webhook event types.
MONITOR_TYPES = ("event_stream", "snapshot")
EVENT_TYPES = ("monitor.event.detected", "monitor.execution.completed", "monitor.execution.failed")
DEFAULT_SUBSCRIPTION = ("monitor.event.detected",)
UPDATABLE = ("frequency", "metadata", "webhook", "advanced")


def frequency_hours(value: Column) -> Column:
    """Hours of a preset or ``<n>{h,d,w}``; null outside 1 hour to 30 days."""
    text = value
    for preset, short in FREQUENCY_PRESETS.items():
        text = F.when(value == preset, short).otherwise(text)
    n = F.regexp_extract(text, r"^(\d+)[hdw]$", 1).try_cast("bigint")
    unit = F.regexp_extract(text, r"^\d+([hdw])$", 1)
    hours = n * F.when(unit == "h", 1).when(unit == "d", 24).when(unit == "w", 168)
    return F.when(hours.between(1, 720), hours)


def check_frequency(value: str) -> str:
    short = FREQUENCY_PRESETS.get(value, value)
    found = re.fullmatch(r"(\d+)([hdw])", short)
    if not found or not 1 <= int(found[1]) * {"h": 1, "d": 24, "w": 168}[found[2]] <= 720:
        raise ValueError(f"frequency must be a preset or <n>h, <n>d, <n>w from 1h to 30d: {value!r}")
    return short


def new_monitor(
    monitor_type: str, *, frequency: str, query: str | None = None, task_run_id: str | None = None, **settings
) -> dict:
    """Checked first version of a monitor, ready to append to the registry table."""
    if monitor_type not in MONITOR_TYPES:
        raise ValueError(f"type must be one of {MONITOR_TYPES}")
    if monitor_type == "event_stream" and not query:
        raise ValueError("an event_stream monitor needs a query")
    if monitor_type == "snapshot" and not task_run_id:
        raise ValueError("a snapshot monitor needs a task run")
    return {
        "type": monitor_type, "frequency": check_frequency(frequency), "query": query,
        "task_run_id": task_run_id, "status": "active", **settings,
    }


def monitor_update(**fields) -> dict:
    """Checked update version: given fields only."""
    given = {k: v for k, v in fields.items() if v is not None}
    if not given:
        raise ValueError("nothing to update")
    fixed = set(given) - set(UPDATABLE)
    if fixed:
        raise ValueError(f"cannot be updated: {sorted(fixed)}")
    if "frequency" in given:
        given["frequency"] = check_frequency(given["frequency"])
    return given


def monitor_cancel() -> dict:
    """The version that cancels a monitor for good."""
    return {"status": "cancelled"}


def current_monitors(
    versions: DataFrame, key: str, version: Sequence[str], fixed: Sequence[str], updatable: Sequence[str]
) -> DataFrame:
    """Current row per monitor: fixed fields from the first version, the others from the newest
    version that gives them; ``cancelled`` stays once seen, and versions after it change nothing."""
    order = F.struct(*version)
    # Cancellations are few; dealt out once more, so that a monitor with very many versions can be split.
    ended = versions.filter("status = 'cancelled'").groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_end"))
    met = versions.join(ended.hint("rebalance"), F.col(key).eqNullSafe(F.col("_key")), "left")
    counted = met.filter(F.col("_end").isNull() | (order <= F.col("_end")))
    return counted.groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in fixed],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in updatable],
        F.when(F.bool_or(F.col("status") == "cancelled"), "cancelled").otherwise("active").alias("status"),
        F.count(F.lit(1)).alias("versions"),
        F.min(F.struct(*version))[version[0]].alias("created_at"),
    )


def page(df: DataFrame, order: Sequence[str], limit: int, cursor: Sequence | None = None) -> DataFrame:
    """Newest first keyset page; ``cursor`` is the order key of the last row of the page before."""
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must be from 1 to 10000")
    return _after(df, order, cursor).limit(limit)


def _after(df: DataFrame, order: Sequence[str], cursor: Sequence | None) -> DataFrame:
    """The rows behind a cursor, newest first; nulls are the oldest."""
    if cursor is not None:
        kinds = [f.dataType for f in df.select(*order).schema]
        behind = F.lit(False)
        for c, v, kind in reversed(list(zip(order, cursor, kinds))):
            if v is None:
                behind = F.col(c).isNull() & behind
            else:
                at = moment(v, kind)
                behind = F.col(c).isNull() | (F.col(c) < at) | ((F.col(c) == at) & behind)
        if cursor[0] is not None:
            # This test alone can be pushed to the scan.
            df = df.filter(F.col(order[0]).isNull() | (F.col(order[0]) <= moment(cursor[0], kinds[0])))
        df = df.filter(behind)
    return df.orderBy(*[F.desc(c) for c in order])


def next_cursor(df: DataFrame, order: Sequence[str], limit: int, cursor: Sequence | None = None) -> tuple | None:
    """Cursor of the page after ``page(df, order, limit, cursor)``; None when that is the last one."""
    if not 1 <= limit <= 10_000:
        raise ValueError("limit must be from 1 to 10000")
    seen = _after(df.select(*order), order, cursor).offset(limit - 1).limit(2).collect()
    return tuple(seen[0]) if len(seen) == 2 else None


def list_monitors(
    monitors: DataFrame, key: str, *, status: str | None = "active", monitor_type: str | None = None,
    limit: int = 100, cursor: Sequence | None = None,
) -> DataFrame:
    if status:
        monitors = monitors.filter(F.col("status") == status)
    if monitor_type:
        monitors = monitors.filter(F.col("type") == monitor_type)
    return page(monitors, ["created_at", key], limit, cursor)


def list_events(
    events: DataFrame, order: Sequence[str], *, group: Mapping[str, object] | None = None,
    include_completions: bool = False, limit: int = 20, cursor: Sequence | None = None,
) -> DataFrame:
    """Newest events; with ``group`` the whole of one execution, and paging does not apply."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must be from 1 to 100")
    if group is not None:
        for column, value in group.items():
            events = events.filter(F.col(column) == F.lit(value))
        return events
    if not include_completions:
        events = events.filter(F.col("event_type") != "completion")
    return page(events, order, limit, cursor)


def event_summary(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(type, id, date, summary)`` of event rows, by event type.

    ``output`` and ``changed_output`` are JSON text; their ``content`` is what a summary shows.
    """
    kind = F.col("event_type")
    reference = F.when(
        kind.isin("event_stream", "snapshot"),
        F.coalesce(F.when(F.col("event_group_id") != "", F.col("event_group_id")), "event_id", F.lit("")),
    ).otherwise("")
    date = (
        F.when(kind.isin("event_stream", "snapshot"), F.coalesce("event_date", F.lit("")))
        .when(kind.isin("completion", "error"), F.coalesce("timestamp", F.lit("")))
        .otherwise("")
    )
    content = lambda c: F.get_json_object(c, "$.content")
    filled = lambda c: F.when(c != "", c)
    summary = (
        F.when(kind == "event_stream", F.coalesce(filled(content("output")), "output", F.lit("")))
        .when(kind == "snapshot", F.coalesce(filled(content("changed_output")), F.lit("fields changed")))
        .when(kind == "completion", "Run completed (no change)")
        .when(kind == "error", F.coalesce("error_message", F.lit("")))
        .otherwise("")
    )
    return events.select(
        *keep, kind.alias("type"), reference.alias("id"), date.alias("date"), F.left(summary, F.lit(50)).alias("summary")
    )


def change_events(
    runs: DataFrame, key: str, order: Sequence[str], state: str, *, backfill: bool = False, completions: bool = False
) -> DataFrame:
    """One row per execution that changed the monitored state.

    The first run of a key is an event only with ``backfill``; other runs without a change are
    completions, returned only when asked for.
    """
    text = runs.select(key, *order, F.col(state).cast("string").alias(state))
    seen = with_previous(text, key, order, state, changed_only=not completions)
    changed = (F.col("first") & F.lit(backfill)) | (
        ~F.col("first") & ~F.col("previous").eqNullSafe(F.col(state))
    )
    typed = seen.withColumn("event_type", F.when(changed, "event_stream").otherwise("completion")).drop("first")
    return typed if completions else typed.filter(F.col("event_type") == "event_stream")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between two snapshots with one row per key."""
    old = before.select(F.col(key).alias("_k"), F.struct(*columns).alias("_old"))
    new = after.select(F.col(key).alias("_n"), F.struct(*columns).alias("_new"))
    joined = old.join(new, F.col("_k") == F.col("_n"), "full_outer")
    change = (
        F.when(F.col("_k").isNull(), "added")
        .when(F.col("_n").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    pairs = [x for c in columns for x in (F.col(f"_old.{c}").alias(f"old_{c}"), F.col(f"_new.{c}").alias(f"new_{c}"))]
    return joined.select(F.coalesce("_k", "_n").alias(key), change.alias("change"), *pairs).filter("change is not null")


def schedule(monitors: DataFrame, key: str, start: str, end: Column, frequency: str = "frequency") -> DataFrame:
    """Due runs of each monitor from its start up to ``end``: ``(key, run_at, trigger)``.

    A monitor whose frequency is unknown has one row, without a time and with the reason as its trigger.
    """
    hours = frequency_hours(F.col(frequency))
    step = F.make_dt_interval(hours=hours.cast("int"))
    reason = F.concat(F.lit("invalid frequency: "), F.coalesce(F.col(frequency), F.lit("null")))
    wrong = monitors.filter(hours.isNull()).select(
        key, F.lit(None).cast(monitors.schema[start].dataType).alias("run_at"), reason.alias("trigger")
    )
    due = (
        monitors.filter(hours.isNotNull() & (F.col(start) <= end))
        .select(key, F.explode(F.sequence(F.col(start), end, step)).alias("run_at"))
        .withColumn("trigger", F.lit("schedule"))
    )
    return due.unionByName(wrong)


def with_manual(due: DataFrame, manual: DataFrame) -> DataFrame:
    """Add manual runs; the schedule itself does not move."""
    return due.unionByName(manual.withColumn("trigger", F.lit("manual")).select(*due.columns))


def outbox(events: DataFrame, subscriptions: DataFrame, key: str, event_type: str, types: str) -> DataFrame:
    """Events whose type the monitor's webhook subscribes to; no list means the default type."""
    default = F.array(*[F.lit(t) for t in DEFAULT_SUBSCRIPTION])
    listed = F.when(F.size(types) > 0, F.col(types)).otherwise(default)
    wanted = subscriptions.select(key, F.explode(F.array_distinct(listed)).alias(event_type))
    return events.join(wanted, [key, event_type], "left_semi")


def window_counts(events: DataFrame, ts: str, by: Sequence[str], frequency: str = "daily") -> DataFrame:
    """Events per tumbling window of the given frequency: ``(window_start, by…, events)``."""
    short = check_frequency(frequency)
    unit = {"h": "hours", "d": "days", "w": "weeks"}[short[-1]]
    span = F.window(F.col(ts), f"{short[:-1]} {unit}")
    return events.groupBy(span.alias("_w"), *by).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("_w.start").alias("window_start"), *by, "events"
    )
