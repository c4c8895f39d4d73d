"""Enrichment of streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import TimestampNTZType

from tablerich.operators.enrich import Outputs, enrich
from tablerich.operators.inputs import Inputs
from tablerich.operators.resolvers import Resolver


def enrich_stream(
    df: DataFrame, inputs: Inputs, outputs: Outputs, resolver: Resolver, *, name: str = "enriched_data",
    include_basis: bool = False,
) -> DataFrame:
    """One JSON text column per row; works on a stream and on a micro-batch.

    With a table resolver this is a stateless join of the stream with a static table.
    """
    return enrich(df, inputs, outputs, resolver).json_column(name, include_basis)


def batch_enricher(
    inputs: Inputs, outputs: Outputs, resolver: Resolver, *, name: str = "enriched_data", include_basis: bool = False
) -> Callable[[DataFrame, int], DataFrame]:
    """A function ``(batch, batch_id) -> enriched batch`` to call inside ``foreachBatch``."""

    def run(batch: DataFrame, batch_id: int) -> DataFrame:
        return enrich_stream(batch, inputs, outputs, resolver, name=name, include_basis=include_basis)

    return run


def batch_writer(
    path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink. A batch run again replaces its own folder, so rows are not doubled."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch if transform is None else transform(batch, batch_id)
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_stream(df: DataFrame, path: str, checkpoint: str, *, every: str | None = None, once: bool = False) -> StreamingQuery:
    """Write a stream as Parquet: a batch ``every`` span of time, or what is there at ``once``; without either, batch after batch."""
    if every is not None and once:
        raise ValueError("a stream runs at intervals or once")
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if every is not None:
        writer = writer.trigger(processingTime=every)
    elif once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def with_event_time(df: DataFrame, ts: str, delay: str = "10 seconds") -> DataFrame:
    """Set the watermark; stateful operators downstream drop rows later than ``delay``.

    A time without a zone counts as UTC, whatever the zone of the session.
    """
    moment = F.col(ts)
    if df.schema[ts].dataType == TimestampNTZType():
        moment = F.convert_timezone(F.lit("UTC"), F.current_timezone(), moment)
    return df.withColumn(ts, moment.cast("timestamp")).withWatermark(ts, delay)


def utc_clock(moment: Column) -> Column:
    """The UTC date and time of a moment, without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))


def first_per_key(df: DataFrame, ts: str, key: list[str], delay: str = "10 seconds") -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return with_event_time(df, ts, delay).dropDuplicatesWithinWatermark(key)


def closed_windows(df: DataFrame, ts: str, span: str, by: list[str], delay: str) -> DataFrame:
    """Counts per tumbling window; in append mode a window is emitted once it is closed."""
    counted = with_event_time(df, ts, delay).groupBy(F.window(ts, span), *by).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), *by, "events")


class ProgressListener(StreamingQueryListener):
    """Passes ``(batch_id, input_rows, observed metrics)`` of every batch to a callback.

    The callback is optional, and its failures never reach the query.
    """

    def __init__(self, callback: Callable[[int, int, dict], None] | None = None):
        self.callback = callback

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if self.callback is None:
            return
        progress = event.progress
        observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        try:
            self.callback(progress.batchId, progress.numInputRows, observed)
        except Exception:
            pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
