"""Where answers come from: a table, Column expressions, or a Python function.

Every resolver adds one column ``_r`` to the source rows:
``struct<error string, basis array<BASIS>, values struct<one field per output>>``. Values have the type the source of
the answers gives them. ``error`` is null on success. No row is added or lost.
"""

from __future__ import annotations

import json
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablerich.operators.inputs import Inputs, as_column, check_columns, input_json
from tablerich.operators.naming import OutputColumn
from tablerich.session import CALL_ROWS

NO_RESULT = "No result"
RESULT = "_r"
BASIS_TYPE = (
    "array<struct<field:string,citations:array<struct<url:string,excerpts:array<string>>>,"
    "reasoning:string,confidence:string,url:string,title:string,excerpts:array<string>>>"
)

Rows = list[dict]
RowFunction = Callable[[Rows, list[str]], Rows]


def result_struct(error: Column, basis: Column | None, values: Sequence[tuple[str, Column]]) -> Column:
    ok = error.isNull()
    return F.struct(
        error.alias("error"),
        F.when(ok, F.lit(None).cast(BASIS_TYPE) if basis is None else basis).alias("basis"),
        F.struct(*[F.when(ok, v).alias(n) for n, v in values]).alias("values"),
    )


@dataclass(frozen=True)
class TableResolver:
    """Left lookup in a knowledge table.

    ``on`` maps input names to knowledge columns, ``answers`` output names to knowledge columns or
    expressions over them. ``unique`` promises one knowledge row per key; without it the knowledge is
    first reduced to one row per key. Spark picks the join: it broadcasts the knowledge only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold``, and splits skewed source
    partitions otherwise. For the latter the reduced knowledge is dealt out once more: Spark cannot split the
    partitions of a join that an aggregation by its key feeds.
    """

    knowledge: DataFrame
    on: Mapping[str, str]
    answers: Mapping[str, str | Column]
    basis: Column | None = None
    unique: bool = False

    def attach(self, df: DataFrame, inputs: Inputs, outputs: Sequence[OutputColumn]) -> DataFrame:
        unknown = set(self.on) - set(inputs)
        if unknown:
            raise ValueError(f"resolver keys are not inputs: {sorted(unknown)}")
        keys = {f"_k{i}": as_column(c) for i, c in enumerate(self.on.values())}
        place = {o.name: f"_a{i}" for i, o in enumerate(outputs) if o.name in self.answers}
        payload = {"_hit": F.lit(True)}
        payload |= {c: as_column(self.answers[n]) for n, c in place.items()}
        if self.basis is not None:
            payload["_kb"] = self.basis.cast(BASIS_TYPE)
        known = self.knowledge.select(*[c.alias(n) for n, c in {**keys, **payload}.items()])
        if not self.unique:
            one = F.min(F.struct(*payload)).alias("_one")
            maps = {f.name: F.to_json(f.name) for f in known.schema if f.dataType.typeName() == "map"}
            known = known.withColumns(maps).groupBy(*keys).agg(one).select(*keys, "_one.*").hint("rebalance")
        joined = df.join(known, [as_column(inputs[n]) == F.col(k) for n, k in zip(self.on, keys)], "left_outer")
        missing = F.lit(None).cast("string")
        values = [(o.name, F.col(place[o.name]) if o.name in place else missing) for o in outputs]
        basis = F.col("_kb") if self.basis is not None else None
        result = result_struct(F.when(F.col("_hit").isNull(), NO_RESULT), basis, values)
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], result.alias(RESULT))


@dataclass(frozen=True)
class ExprResolver:
    """Answers computed from the source row by Column expressions."""

    answers: Mapping[str, Column]
    error: Column | None = None
    basis: Column | None = None

    def attach(self, df: DataFrame, inputs: Inputs, outputs: Sequence[OutputColumn]) -> DataFrame:
        error = F.lit(None).cast("string") if self.error is None else self.error
        missing = F.lit(None).cast("string")
        values = [(o.name, self.answers.get(o.name, missing)) for o in outputs]
        basis = None if self.basis is None else self.basis.cast(BASIS_TYPE)
        return df.withColumn(RESULT, result_struct(error, basis, values))


def call_in_chunks(fn: RowFunction, rows: Rows, names: list[str], size: int = CALL_ROWS) -> Rows:
    """Results aligned with ``rows``; a failed call marks the rows of its own chunk only."""
    out: Rows = []
    for start in range(0, len(rows), size):
        chunk = rows[start : start + size]
        try:
            got = list(fn(chunk, names))
        except Exception as exc:
            got = [{"error": str(exc)}] * len(chunk)
        got += [{"error": NO_RESULT}] * (len(chunk) - len(got))
        out += [r if r else {"error": NO_RESULT} for r in got[: len(chunk)]]
    return out


def call_in_time(
    fn: RowFunction, rows: Rows, names: list[str], size: int, parallel: int, until: float | None, late: str
) -> Rows:
    """As ``call_in_chunks`` with ``parallel`` calls at a time; rows of calls that are not back by ``until`` get the error ``late``."""
    starts = range(0, len(rows), size)
    out: list[Rows | None] = [None] * len(starts)
    waiting = deque(enumerate(starts))
    # Set whenever a thread ends.
    ended = threading.Semaphore(0)

    def work() -> None:
        while until is None or time.monotonic() < until:
            try:
                place, start = waiting.popleft()
            except IndexError:
                break
            out[place] = call_in_chunks(fn, rows[start : start + size], names, size)
        ended.release()

    # A thread whose call hangs is left behind; it ends with the process.
    threads = [threading.Thread(target=work, daemon=True) for _ in range(min(parallel, len(starts)))]
    for thread in threads:
        thread.start()
    for _ in threads:
        if not ended.acquire(timeout=None if until is None else max(0.0, until - time.monotonic())):
            break
    found = list(out)
    return [r for got, start in zip(found, starts) for r in (got if got is not None else [{"error": late}] * len(rows[start : start + size]))]


def as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


@dataclass(frozen=True)
class CallableResolver:
    """A user's Python function, called with at most ``chunk`` rows at a time in Arrow batches.

    The function gets a list of input dicts and the output names, and returns one dict per input:
    the outputs, optionally ``basis``, or ``error``. Spark may run a task again, so calls happen at
    least once. ``dedupe`` asks for each distinct input only once; ``partitions`` deals the rows out
    before the calls, for slow calls on few rows. ``parallel`` calls run at a time in each task. With ``deadline``
    seconds, counted in each task from its first call, answers that are back in time are kept and the rows of all
    other calls get an error; a call that hangs takes the rows of its own chunk with it.
    """

    fn: RowFunction
    chunk: int = CALL_ROWS
    dedupe: bool = False
    partitions: int | None = None
    parallel: int = 1
    deadline: float | None = None

    def __post_init__(self):
        if self.parallel < 1 or self.chunk < 1 or (self.deadline is not None and self.deadline <= 0):
            raise ValueError("chunk, parallel and deadline must be positive")

    def attach(self, df: DataFrame, inputs: Inputs, outputs: Sequence[OutputColumn]) -> DataFrame:
        names = [o.name for o in outputs]
        fn, size, parallel, deadline = self.fn, self.chunk, self.parallel, self.deadline
        late = "" if deadline is None else f"timed out after {deadline:g}s"

        def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            until = None if deadline is None else time.monotonic() + deadline
            for batch in batches:
                rows = [json.loads(x) for x in batch]
                if parallel == 1 and deadline is None:
                    results = call_in_chunks(fn, rows, names, size)
                else:
                    results = call_in_time(fn, rows, names, size, parallel, until, late)
                yield pd.Series([_result_text(r, names) for r in results], dtype="object")

        udf = F.pandas_udf(call, T.StringType()).asNondeterministic()
        fields = ",".join(f"`{n}`:string" for n in names)
        schema = f"struct<error:string,basis:{BASIS_TYPE},values:struct<{fields}>>"
        sent = input_json(inputs)
        deal = (lambda d: d.repartition(self.partitions)) if self.partitions else (lambda d: d)
        if not self.dedupe:
            return deal(df).withColumn(RESULT, F.from_json(udf(sent), schema))
        keyed = df.withColumn("_sent", sent)
        answers = deal(keyed.select("_sent").distinct()).withColumn(RESULT, F.from_json(udf("_sent"), schema))
        return keyed.join(answers, "_sent").drop("_sent")


def _result_text(result: dict, names: list[str]) -> str:
    if result.get("error") is not None:
        return json.dumps({"error": str(result["error"])}, ensure_ascii=False)
    return json.dumps(
        {"basis": result.get("basis"), "values": {n: as_text(result.get(n)) for n in names}},
        ensure_ascii=False,
    )


Resolver = TableResolver | ExprResolver | CallableResolver


def resolve(
    df: DataFrame, inputs: Inputs, outputs: Sequence[OutputColumn], resolver: Resolver
) -> DataFrame:
    check_columns(df, inputs)
    return resolver.attach(df, inputs, outputs)
