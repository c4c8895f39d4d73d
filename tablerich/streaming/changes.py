"""Change detection on a stream, with the state that the engine keeps.

Per key the stream state holds the last row that counted (its place in the order, and its text), in RocksDB, so a batch
reads and writes the keys it has rows of and no others. A timer in event time forgets a key that has had no row for a
while. Output is append-only and goes to any sink of the engine; a failed batch is run again from its checkpoint.

Rows of a key are ordered inside a batch. A row that is not newer than the last one of its key, from an earlier batch,
changes nothing and is reported as ``late``. The rows a key has in one batch meet in one task, without other columns;
what a batch takes from its source bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from tablerich.session import separate_session
from tablerich.streaming.enrichment import with_event_time

#: What stateful processing in Python needs.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
LATE = "late"
#: Stands for null in whole numbers of the order, below all of the type's other values.
NONE = {T.ByteType: -(1 << 7), T.ShortType: -(1 << 15), T.IntegerType: -(1 << 31), T.LongType: -(1 << 63)}


def state_session(spark: SparkSession) -> SparkSession:
    """A session to read the stream with; the settings of ``spark`` stay as they are."""
    return separate_session(spark, STATE)


def _plain(value):
    """A value as state holds it."""
    if value is None or (not isinstance(value, str) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


class LastRow(StatefulProcessor):
    """Compares the rows of a key with the one before."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], state: str, kinds: T.StructType, backfill: bool, completions: bool, expire_ms: int | None):
        self.columns, self.order, self.state, self.kinds = list(columns), list(order), state, kinds
        self.backfill, self.completions, self.expire_ms = backfill, completions, expire_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.kinds)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True)
        found = found.sort_values([*self.order, self.state], kind="stable", na_position="first", ignore_index=True)
        known = self.last.get() if self.last.exists() else None
        late = found.iloc[:0]
        if known is not None:
            place = tuple(known[: len(self.order)])
            newer = [_after(tuple(map(_plain, r)), place) for r in found[self.order].itertuples(index=False, name=None)]
            late, found = found[[not n for n in newer]], found[newer].reset_index(drop=True)
        parts = [late.assign(previous=None, event_type=LATE)]
        if len(found):
            previous = found[self.state].shift(1)
            first = pd.Series(False, found.index)
            if known is None:
                first.iloc[0] = True
            else:
                previous.iloc[0] = known[len(self.order)]
            now = found[self.state]
            same = (now == previous) | (now.isna() & previous.isna())
            changed = (first & self.backfill) | (~first & ~same)
            parts.append(found.assign(previous=previous.astype(object).where(previous.notna(), None), event_type=changed.map({True: "event_stream", False: "completion"})))
            if not self.completions:
                parts[-1] = parts[-1][changed]
            newest = found.iloc[-1]
            self.last.update(tuple(_plain(newest[c]) for c in [*self.order, self.state]))
        if self.expire_ms is not None and len(found):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            moment = found["change_moment"].max()
            self.handle.registerTimer(int(moment) + self.expire_ms)
        out = pd.concat([p for p in parts if len(p)] or parts[:1], ignore_index=True)
        yield out.assign(change_key=key[0])[["change_key", *self.columns, "previous", "event_type"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def _after(a: tuple, b: tuple) -> bool:
    """Whether ``a`` comes after ``b``; null comes first."""
    for x, y in zip(a, b):
        if x != y:
            return y is None if x is None or y is None else x > y
    return False


def detect_changes(
    df: DataFrame, key: str, order: Sequence[str], state: str, *, backfill: bool = False, completions: bool = False,
    event_time: str | None = None, delay: str = "10 seconds", expire_after: int | None = None,
) -> DataFrame:
    """A stream of ``key, order…, state, previous, event_type``; ``late`` rows included.

    As ``monitor.change_events``: an event for each change, for first rows with ``backfill``, ``completion`` for all
    others if asked for. With ``expire_after`` seconds a key without rows for so long, by ``event_time`` and its
    watermark ``delay``, is forgotten, and its next row is a first one. ``df`` is read with ``state_session``.
    """
    columns = list(dict.fromkeys([key, *order, state]))
    types = {c: df.schema[c].dataType for c in columns} | {state: T.StringType()}
    # A null key is a key, and whole numbers stay whole: pandas knows no null among them.
    rows = df.withColumns(
        {"change_key": F.to_json(F.struct(key)), state: F.col(state).cast("string")}
        | {c: F.coalesce(F.col(c), F.lit(NONE[type(types[c])]).cast(types[c])) for c in order if isinstance(types[c], T.IntegralType)}
    )
    passed = ["change_key", *[c for c in columns if c != key or c in order]]
    if expire_after is None:
        rows, mode = rows.select(*passed, F.lit(0).cast("bigint").alias("change_moment")), "none"
    else:
        if event_time is None:
            raise ValueError("expire_after needs event_time")
        timed = with_event_time(rows.withColumn("change_time", F.col(event_time)), "change_time", delay)
        rows, mode = timed.select(*passed, "change_time", F.unix_millis("change_time").alias("change_moment")), "eventTime"
    held = T.StructType([*[rows.schema[c] for c in order], T.StructField("state", T.StringType())])
    out = T.StructType([*[rows.schema[c] for c in passed], T.StructField("previous", T.StringType()), T.StructField("event_type", T.StringType())])
    processor = LastRow(passed[1:], order, state, held, backfill, completions, None if expire_after is None else expire_after * 1000)
    found = rows.groupBy("change_key").transformWithStateInPandas(processor, out, "append", mode)
    named = T.StructType([T.StructField(key, types[key])])
    back = {c: F.nullif(F.col(c), F.lit(NONE[type(types[c])]).cast(types[c])) for c in order if isinstance(types[c], T.IntegralType)}
    back = {key: F.from_json("change_key", named)[key]} | back
    return found.withColumns(back).select(*columns, "previous", "event_type")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("event_type") != LATE)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after a newer one of their key."""
    return spark.read.parquet(path).filter(F.col("event_type") == LATE).drop("previous", "event_type")
