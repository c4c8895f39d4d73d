"""Queries: monitors on the events table (monitored key: the user)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tablerich.operators import monitor as M
from tablerich.plans.catalog import query, table

_FREQUENCY = "CASE event_type WHEN 'click' THEN 'hourly' WHEN 'view' THEN '3d' WHEN 'signup' THEN 'weekly' END"
_METADATA = "CASE event_type WHEN 'purchase' THEN props END"
_STATUS = """CASE WHEN event_type = 'error' AND props = '{"k": 0}' THEN 'cancelled' ELSE 'active' END"""
_KIND = "CASE WHEN event_type IN ('click', 'view') THEN 'event_stream' ELSE 'snapshot' END"


def versions(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.expr(_KIND).alias("type"), F.expr(_FREQUENCY).alias("frequency"),
        F.expr(_METADATA).alias("metadata"), F.expr(_STATUS).alias("status"),
    )


def monitors(spark, sf):
    return M.current_monitors(
        versions(spark, sf), "user_id", ["ts", "event_id"], fixed=["type"], updatable=["frequency", "metadata"]
    )


_CURRENT = f"""
SELECT user_id, first(type ORDER BY ts, event_id) AS type,
       first(frequency ORDER BY ts DESC, event_id DESC) FILTER (frequency IS NOT NULL) AS frequency,
       first(metadata ORDER BY ts DESC, event_id DESC) FILTER (metadata IS NOT NULL) AS metadata,
       CASE WHEN bool_or(status = 'cancelled') THEN 'cancelled' ELSE 'active' END AS status,
       count(*) AS versions, min(ts) AS created_at
FROM (SELECT *, min(CASE WHEN status = 'cancelled' THEN row(ts, event_id) END) OVER (PARTITION BY user_id) AS ended FROM (
  SELECT *, {_KIND} AS type, {_FREQUENCY} AS frequency, {_METADATA} AS metadata, {_STATUS} AS status FROM events))
WHERE ended IS NULL OR row(ts, event_id) <= ended
GROUP BY user_id"""


@query("monitor_current", _CURRENT)
def monitor_current(spark, sf):
    return monitors(spark, sf)


@query(
    "monitor_list",
    f"""
WITH c AS ({_CURRENT})
SELECT user_id, type, frequency, created_at FROM c
WHERE status = 'active' AND (created_at, user_id) < (TIMESTAMP '2024-01-01 18:00:00', 0)
ORDER BY created_at DESC, user_id DESC LIMIT 50""",
)
def monitor_list(spark, sf):
    listed = M.list_monitors(monitors(spark, sf), "user_id", limit=50, cursor=(datetime(2024, 1, 1, 18), 0))
    return listed.select("user_id", "type", "frequency", "created_at")


_EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'completion' WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'snapshot'
  WHEN 'click' THEN 'event_stream' ELSE 'other' END"""


def monitor_rows(spark, sf):
    return table(spark, sf, "events").select("user_id", "ts", "event_id", F.expr(_EVENT_TYPE).alias("event_type"))


@query(
    "monitor_events",
    f"""
SELECT event_id, event_type, ts FROM (SELECT event_id, ts, {_EVENT_TYPE} AS event_type FROM events)
WHERE event_type <> 'completion' AND (ts, event_id) < (TIMESTAMP '2024-01-15', 0)
ORDER BY ts DESC, event_id DESC LIMIT 20""",
)
def monitor_events(spark, sf):
    newest = M.list_events(monitor_rows(spark, sf), ["ts", "event_id"], cursor=(datetime(2024, 1, 15), 0))
    return newest.select("event_id", "event_type", "ts")


@query(
    "monitor_event_group",
    f"""
SELECT event_id, event_type FROM (SELECT event_id, user_id, ts, {_EVENT_TYPE} AS event_type FROM events)
WHERE user_id = 8 AND CAST(ts AS DATE) = DATE '2024-01-05'""",
)
def monitor_event_group(spark, sf):
    rows = monitor_rows(spark, sf).withColumn("day", F.to_date("ts"))
    group = {"user_id": 8, "day": date(2024, 1, 5)}
    return M.list_events(rows, ["ts", "event_id"], group=group).select("event_id", "event_type")


_LONG = "'user ' || user_id || ' did ' || event_type || ' with ' || props || ' and nothing else of note happened'"


@query(
    "monitor_event_summary",
    f"""
WITH e AS (SELECT *, {_EVENT_TYPE} AS type, {_LONG} AS body FROM events)
SELECT event_id, type,
  CASE type WHEN 'event_stream' THEN 'u' || user_id WHEN 'snapshot' THEN 'e' || event_id ELSE '' END AS id,
  CASE WHEN type = 'other' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date,
  CASE type WHEN 'event_stream' THEN left(body, 50)
    WHEN 'snapshot' THEN CASE WHEN value > 10 THEN left(body, 50) ELSE 'fields changed' END
    WHEN 'completion' THEN 'Run completed (no change)' WHEN 'error' THEN left(body, 50) ELSE '' END AS summary
FROM e""",
)
def monitor_event_summary(spark, sf):
    body = F.expr(_LONG)
    day = F.date_format("ts", "yyyy-MM-dd")
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        F.expr(_EVENT_TYPE).alias("event_type"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("event_group_id"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        day.alias("event_date"),
        day.alias("timestamp"),
        body.alias("output"),
        F.to_json(F.struct(F.when(F.col("value") > 10, body).alias("content"))).alias("changed_output"),
        body.alias("error_message"),
    )
    return M.event_summary(rows, ["key"]).withColumnRenamed("key", "event_id")


CHANGES_SQL = """
WITH l AS (SELECT event_id, user_id, ts, event_type AS state,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
SELECT event_id, user_id, ts, state, previous FROM l WHERE previous IS NOT NULL AND previous <> state"""


def states(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", F.col("event_type").alias("state"))


@query("change_events", CHANGES_SQL)
def change_events(spark, sf):
    found = M.change_events(states(spark, sf), "user_id", ["ts", "event_id"], "state")
    return found.select("event_id", "user_id", "ts", "state", "previous")


def _last(where: str, name: str) -> str:
    return (
        f"{name} AS (SELECT user_id, first(event_type ORDER BY ts DESC, event_id DESC) AS state FROM events "
        f"WHERE {where} GROUP BY 1)"
    )


# A snapshot is the state as of a moment.
_OLD, _NEW = "ts < TIMESTAMP '2024-01-02'", "ts < TIMESTAMP '2024-01-31'"


@query(
    "snapshot_diff",
    f"""
WITH {_last(_OLD, 'o')}, {_last(_NEW, 'n')}
SELECT coalesce(o.user_id, n.user_id) AS user_id, CASE WHEN o.user_id IS NULL THEN 'added'
  WHEN n.user_id IS NULL THEN 'removed' ELSE 'changed' END AS change, o.state AS old_state, n.state AS new_state
FROM o FULL JOIN n ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.user_id IS NULL OR o.state <> n.state""",
)
def snapshot_diff(spark, sf):
    last = lambda where: (
        states(spark, sf)
        .filter(where.replace("TIMESTAMP", "TIMESTAMP_NTZ"))
        .groupBy("user_id")
        .agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"))
    )
    return M.snapshot_diff(last(_OLD), last(_NEW), "user_id", ["state"])


_START = "min(ts) AS started, first({f} ORDER BY ts, event_id) AS frequency".format(
    f="CASE event_type WHEN 'click' THEN '12h' WHEN 'view' THEN 'daily' WHEN 'signup' THEN 'every_two_weeks' "
    "WHEN 'error' THEN '1w' ELSE '45d' END"
)
_SCHEDULE = f"""
WITH m AS (SELECT user_id, {_START} FROM events GROUP BY 1),
h AS (SELECT user_id, started, frequency, CASE frequency WHEN '12h' THEN 12 WHEN 'daily' THEN 24 WHEN 'every_two_weeks' THEN 336
        WHEN '1w' THEN 168 END AS hours FROM m),
due AS (SELECT user_id, unnest(generate_series(started, TIMESTAMP '2024-01-31', to_hours(hours))) AS run_at
        FROM h WHERE hours IS NOT NULL)
SELECT user_id, run_at, 'schedule' AS trigger FROM due
UNION ALL SELECT user_id, NULL, 'invalid frequency: ' || frequency FROM h WHERE hours IS NULL"""


def _due(spark, sf):
    frequency = F.expr(
        "CASE event_type WHEN 'click' THEN '12h' WHEN 'view' THEN 'daily' WHEN 'signup' THEN 'every_two_weeks' "
        "WHEN 'error' THEN '1w' ELSE '45d' END"
    )
    started = table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("started"), F.min_by(frequency, F.struct("ts", "event_id")).alias("frequency")
    )
    return M.schedule(started, "user_id", "started", F.lit("2024-01-31").cast("timestamp_ntz"))


@query("monitor_schedule", _SCHEDULE)
def monitor_schedule(spark, sf):
    return _due(spark, sf)


@query(
    "monitor_trigger",
    f"{_SCHEDULE} UNION ALL SELECT user_id, ts AS run_at, 'manual' AS trigger FROM events WHERE event_type = 'purchase'",
)
def monitor_trigger(spark, sf):
    manual = table(spark, sf, "events").filter("event_type = 'purchase'").select("user_id", F.col("ts").alias("run_at"))
    return M.with_manual(_due(spark, sf), manual)


@query(
    "monitor_windows",
    "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2",
)
def monitor_windows(spark, sf):
    return M.window_counts(table(spark, sf, "events"), "ts", ["event_type"], "daily")


_HOOK = """CASE event_type WHEN 'purchase' THEN 'monitor.event.detected' WHEN 'error' THEN 'monitor.execution.failed'
  ELSE 'monitor.execution.completed' END"""


@query(
    "monitor_outbox",
    f"""
WITH e AS (SELECT event_id, user_id, {_HOOK} AS hook FROM events),
s AS (SELECT user_id, bool_or(event_type = 'signup' AND value > 50) AS all_failures FROM events GROUP BY 1)
SELECT event_id, e.user_id, hook FROM e JOIN s ON e.user_id = s.user_id
WHERE (all_failures AND hook <> 'monitor.execution.completed')
   OR (NOT all_failures AND hook = 'monitor.event.detected')""",
)
def monitor_outbox(spark, sf):
    events = table(spark, sf, "events")
    rows = events.select("event_id", "user_id", F.expr(_HOOK).alias("hook"))
    wide = F.bool_or((F.col("event_type") == "signup") & (F.col("value") > 50))
    subscriptions = events.groupBy("user_id").agg(
        F.when(wide, F.array(F.lit(M.EVENT_TYPES[0]), F.lit(M.EVENT_TYPES[2]))).alias("types")
    )
    return M.outbox(rows, subscriptions, "user_id", "hook", "types").select("event_id", "user_id", "hook")
