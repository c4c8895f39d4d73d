"""Exact order over all rows, or over all rows of a key, without a one-task window.

A window with no partition key, or with one hot key, sorts everything in a single task. Here rows are
range-partitioned on the whole order (a hot key, or a hot moment of it, is cut between its rows), sorted
inside each partition, and only one or two small rows per partition take part in the global step. The
partitioned rows are written once, because a second evaluation could draw other range bounds.

Running totals and previous rows are found in one Arrow pass over the sorted rows: a window inside the
ranges would need a second shuffle of everything.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablerich.session import cut_lineage

_POSITION_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """``row_number() over (order by …)``; ``order`` must be total."""
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
            }
        )
    )
    fixed = cut_lineage(ranged, "numbered")
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return fixed.join(F.broadcast(offsets), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_offset") + F.col("_pos") + 1).alias(name)
    )


def batch_ids(df: DataFrame, order: Sequence[str | Column], size: int = 100) -> DataFrame:
    """Add ``batch_id``: 1, 2, … with ``size`` rows each, in the given order."""
    numbered = number_rows(df, order, "_rn")
    return numbered.withColumn("batch_id", F.expr(f"(_rn - 1) div {int(size)} + 1")).drop("_rn")


def batch_slice(df: DataFrame, order: Sequence[str | Column], batch: int, size: int = 100) -> DataFrame:
    """The rows of one batch, by their rank: of the table only the range of values that holds the batch is sorted."""
    first, last = (batch - 1) * int(size), batch * int(size)
    near, before = _around(df, order[0], first, last)
    rank = F.col("_rn") + before
    return number_rows(near, order, "_rn").filter((rank > first) & (rank <= last)).drop("_rn")


#: Ranges of equal counts whose bounds are estimated, and the accuracy of the estimate.
_RANGES, _ACCURACY = 500, 10_000


def _around(df: DataFrame, column: str | Column, first: int, last: int) -> tuple[DataFrame, int]:
    """Rows around the ranks ``first`` to ``last`` by the first column of the order, and how many rows come before them.

    Bounds of ranges are estimated in one pass, and the rows before and inside the chosen ones are counted in a second,
    so an estimate that is off only makes the range wider. Columns whose values cannot be estimated are taken whole.
    """
    name, falling = _direction(column)
    if name not in df.columns or not isinstance(df.schema[name].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df, 0
    c = F.col(f"`{name}`")
    bounds = F.percentile_approx(c, [i / _RANGES for i in range(_RANGES + 1)], _ACCURACY)
    found = df.agg(F.count(F.lit(1)).alias("n"), F.count(c).alias("known"), bounds.alias("bounds")).first()
    n, known = found["n"], found["known"]
    if not known:
        return df, 0
    # Ranks of the rising order, in which nulls come first; the falling one is its reverse.
    begin, end = (max(0, n - last), max(0, n - first)) if falling else (first, min(last, n))
    nulls, per = n - known, known / _RANGES
    low, high = int((begin - nulls) // per) - 1, int(-((nulls - end) // per)) + 1
    after = F.lit(True) if low < 0 else c >= F.lit(found["bounds"][min(low, _RANGES)])
    until = F.lit(True) if high > _RANGES else c.isNull() | (c <= F.lit(found["bounds"][high])) if high >= 0 else c.isNull()
    inside, earlier = F.coalesce(after & until, F.lit(False)), ~F.coalesce(after, F.lit(False))
    counted = df.agg(F.count_if(earlier).alias("earlier"), F.count_if(inside).alias("inside")).first()
    if counted["earlier"] > begin or counted["earlier"] + counted["inside"] < end:
        return df, 0
    return df.filter(inside), n - counted["earlier"] - counted["inside"] if falling else counted["earlier"]


def _direction(column: str | Column) -> tuple[str | None, bool]:
    """Name of a plain column of an order and whether it falls; no name for any other expression."""
    if isinstance(column, str):
        return column, False
    found = re.fullmatch(r"Column<'(.+?)( ASC NULLS FIRST| DESC NULLS LAST)?'>", str(column))
    return (found[1], (found[2] or "").startswith(" DESC")) if found else (None, False)


def chunk_sizes(df: DataFrame, by: Sequence[str], size: int = 1000) -> DataFrame:
    """How each group is cut into calls of at most ``size`` rows: ``(by…, chunk, rows)``."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    last = F.ceil(F.col("_n") / F.lit(size))
    return counts.withColumn("chunk", F.explode(F.sequence(F.lit(1).cast("bigint"), last))).select(
        *by,
        "chunk",
        F.least(F.lit(size), F.col("_n") - (F.col("chunk") - 1) * size).alias("rows"),
    )


def _before(batch: pa.RecordBatch, last: pa.RecordBatch | None, name: str) -> pa.Array:
    """The column shifted by one row; the row before the batch is ``last``."""
    column = batch.column(name)
    first = pa.nulls(1, column.type) if last is None else last.column(name)
    return pa.concat_arrays([first, column.slice(0, len(column) - 1)])


def _equal(a: pa.Array, b: pa.Array) -> pa.Array:
    """Null-safe equality."""
    return pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))


def same_key(batch: pa.RecordBatch, last: pa.RecordBatch | None, keys: Sequence[str]) -> pa.Array:
    """Whether each row has the key of the row before it."""
    same = None
    for k in keys:
        equal = _equal(batch.column(k), _before(batch, last, k))
        same = equal if same is None else pc.and_(same, equal)
    return same if last is not None else pa.concat_arrays([pa.array([False]), same.slice(1)])


def _edges(rows: int, is_first: bool) -> pa.Array:
    return pa.array(["head" if is_first else None] + [None] * (rows - 1), pa.string())


def running_totals(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Replace each of ``values`` by its running total per key, in the given total order.

    Equal to ``sum(value) over (partition by key order by … rows unbounded preceding)``, but a key may
    span many tasks: each task adds up its own rows, and what earlier tasks hold of its first key, one
    small row per task, is added at the end.
    """
    ordering = [F.col(c) for c in [*key, *order]]
    keys, sums = list(key), list(values)
    ranged = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering).withColumns(
        {"_part": F.spark_partition_id(), "_edge": F.lit(None).cast("string")}
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            same = same_key(batch, last, keys).to_numpy(zero_copy_only=False)
            run = (~same).cumsum()
            out = batch
            for v in sums:
                added = pd.Series(pc.fill_null(batch.column(v), 0).to_numpy()).groupby(run).cumsum()
                if last is not None:
                    # Run 0 goes on from the last row of the batch before.
                    added = added + (run == 0) * (last.column(v)[0].as_py() or 0)
                place = out.schema.get_field_index(v)
                out = out.set_column(place, v, pa.array(added, batch.column(v).type))
            out = out.set_column(out.schema.get_field_index("_edge"), "_edge", _edges(out.num_rows, last is None))
            last = out.slice(out.num_rows - 1)
            yield out
        if last is not None:
            yield last.set_column(last.schema.get_field_index("_edge"), "_edge", pa.array(["tail"]))

    scanned = cut_lineage(ranged.mapInArrow(scan, ranged.schema), "running")
    earlier = Window.partitionBy(*keys).orderBy("_part", "_edge").rowsBetween(Window.unboundedPreceding, -1)
    carried = {f"_c{i}": F.sum(F.when(F.col("_edge") == "tail", F.col(v))).over(earlier) for i, v in enumerate(sums)}
    # At most one row per partition: what came before its first key.
    before = (
        scanned.filter(F.col("_edge").isNotNull())
        .select(*keys, "_part", "_edge", *[c.alias(n) for n, c in carried.items()])
        .filter("_edge = 'head' AND _c0 IS NOT NULL")
        .select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *carried)
    )
    same = [F.col("_part") == F.col("_p"), *[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]]
    rows = scanned.filter(F.coalesce(F.col("_edge"), F.lit("")) != "tail").join(F.broadcast(before), same, "left")
    total = {v: F.col(v) + F.coalesce(F.col(f"_c{i}"), F.lit(0)) for i, v in enumerate(sums)}
    return rows.select(*[total[c].alias(c) if c in total else F.col(f"`{c}`") for c in df.columns])


def with_previous(
    df: DataFrame, key: str, order: Sequence[str], state: str, changed_only: bool = False
) -> DataFrame:
    """Add ``previous`` (state of the preceding row of the same key) and ``first`` (no such row).

    Equal to ``lag(state) over (partition by key order by …)`` for a total order, but a key may span
    many tasks. ``changed_only`` keeps first rows and rows whose state differs from the previous one,
    and drops the others before anything is written. ``state`` must be text.
    """
    columns = list(dict.fromkeys([key, *order, state]))
    ordering = [F.col(key), *[F.col(c) for c in order]]
    ranged = (
        df.select(*columns).repartitionByRange(*ordering).sortWithinPartitions(*ordering)
        .withColumn("_part", F.spark_partition_id())
    )
    schema = T.StructType(
        [*ranged.schema.fields, T.StructField("previous", T.StringType()), T.StructField("first", T.BooleanType()),
         T.StructField("_edge", T.StringType())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            same = same_key(batch, last, [key])
            now, before = batch.column(state), _before(batch, last, state)
            previous = pc.if_else(same, before, pa.nulls(len(before), before.type))
            first = pc.invert(same)
            edge = _edges(batch.num_rows, last is None)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, previous, first, edge], [*batch.schema.names, "previous", "first", "_edge"]
            )
            if changed_only:
                kept = pc.or_(first, pc.invert(_equal(now, previous)))
                if last is not None:
                    out = out.filter(kept)
                else:
                    out = out.filter(pa.concat_arrays([pa.array([True]), kept.slice(1)]))
            last = batch.slice(batch.num_rows - 1)
            yield out
        if last is not None:
            yield pa.RecordBatch.from_arrays(
                [*last.columns, pa.nulls(1, last.column(state).type), pa.array([False]), pa.array(["tail"])],
                [*last.schema.names, "previous", "first", "_edge"],
            )

    scanned = cut_lineage(ranged.mapInArrow(scan, schema), "scanned")
    # At most two rows per partition: its first row, and its last row to carry over.
    edges = scanned.filter(F.col("_edge").isNotNull())
    earlier = Window.orderBy("_part", F.col("_edge")).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.when(F.col("_edge") == "tail", F.struct(key, state)), ignorenulls=True).over(earlier)
    heads = (
        edges.withColumn("_c", carried)
        .filter("_edge = 'head'")
        .withColumn("first", ~F.coalesce(F.col(f"_c.{key}").eqNullSafe(F.col(key)) & F.col("_c").isNotNull(), F.lit(False)))
        .withColumn("previous", F.when(~F.col("first"), F.col(f"_c.{state}")))
    )
    if changed_only:
        heads = heads.filter(F.col("first") | ~F.col("previous").eqNullSafe(F.col(state)))
    result = [*columns, "previous", "first"]
    return scanned.filter(F.col("_edge").isNull()).select(*result).unionByName(heads.select(*result))
