"""Queries: streams over the events table, run to the end of the available files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.operators.resolvers import TableResolver
from tablerich.plans.catalog import query, table
from tablerich.plans.queries_monitor import CHANGES_SQL
from tablerich.session import scratch_path
from tablerich.streaming import changes as C
from tablerich.streaming import enrichment as ST


def event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A pattern, because a stream accepts a lone file only from one; it matches a folder as well.
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


def run_to_end(stream, path, sink=None):
    """Process everything available now; Parquet in append mode, or a ``foreachBatch`` sink."""
    writer = stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    if sink is None:
        started = writer.format("parquet").outputMode("append").start(f"{path}/out")
    else:
        started = writer.foreachBatch(sink).start()
    started.awaitTermination()


@query(
    "stream_enrich",
    """
SELECT event_id, user_id, CASE WHEN n_name IS NULL THEN '{"error":"No result"}'
  ELSE '{"country_name":"' || n_name || '"}' END AS enriched_data
FROM events LEFT JOIN nation ON user_id = n_nationkey""",
)
def stream_enrich(spark, sf):
    resolver = TableResolver(
        table(spark, sf, "nation"), {"country": "n_nationkey"}, {"country_name": "n_name"}, unique=True
    )
    stream = event_stream(spark, sf).select("event_id", "user_id")
    path = scratch_path(spark, "stream-enrich")
    run_to_end(ST.enrich_stream(stream, {"country": "user_id"}, ["Country name"], resolver), path)
    return spark.read.parquet(f"{path}/out")


@query(
    "stream_windowed",
    """
SELECT window_start, event_type, events FROM (
  SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def stream_windowed(spark, sf):
    path = scratch_path(spark, "stream-windowed")
    run_to_end(ST.closed_windows(event_stream(spark, sf), "ts", "1 day", ["event_type"], "1 hour"), path)
    out = spark.read.parquet(f"{path}/out")
    return out.withColumn("window_start", ST.utc_clock(F.col("window_start")))


@query("stream_changes", CHANGES_SQL)
def stream_changes(spark, sf):
    path = scratch_path(spark, "stream-changes")
    stream = event_stream(C.state_session(spark), sf).withColumnRenamed("event_type", "state")
    run_to_end(C.detect_changes(stream, "user_id", ["ts", "event_id"], "state"), path)
    return C.read_changes(spark, f"{path}/out").select("event_id", "user_id", "ts", "state", "previous")
