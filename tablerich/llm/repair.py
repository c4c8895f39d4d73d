"""Structure repair of conversations by Hirschberg's divide and conquer.

A repaired conversation has role initials ``(s?(ua)+)?``. Every row is kept, given another role or deleted, and empty
rows may be inserted; an edit costs what ``COSTS`` says, and the cheapest edits are wanted, of equal ones those whose
initials (``D I K R``) come first. What has been written so far leaves one of four states (nothing, ``s``, ``u``,
``a``), so the cheapest way through a stretch of rows is a matrix of four states by four, and two stretches meet in
a state: the forward costs of the left one from its entry and the backward costs of the right one to its exit are
added, and the crossing of least cost is taken. Insertions count to the row behind them, so of two different ways
through the left stretch neither begins the other, and the crossing with the least initials on the left is the one.
``Stretches`` adds them up pairwise and goes back down: it halves every stretch at its crossing until single rows are
left, all conversations of a batch and all stretches of a level at once. Besides the rows it holds sums of four by
four states only.

Conversations of any length are split between tasks. Rows are dealt by ranges of conversation and turn. What lies
inside a range is finished there. Conversations at the edges of a range, and long ones, are cut into stretches of
``CHUNK`` rows, each summed up; the sums of a conversation meet in order, and each stretch is then repaired between
its own entry and exit. Equal rows are one row with a number of copies. What the
contract asks as one value per conversation (the edits, a hash) is put together from the stretches in order.

Null roles and texts are one space; a null ``conv_id`` is a conversation of its own. Rows with one turn are ordered by
role and text; a null turn comes first. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablerich.llm.common import query, table
from tablerich.operators.ordering import same_key
from tablerich.session import cut_lineage

COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
#: States: nothing, ``s``, ``u``, ``a``; an insertion or a new role leads to the next one.
NEXT = (2, 2, 3, 2)
#: Where a conversation may end.
FINAL = (0, 3)
FAR = np.int64(1) << 50
#: Pairs of initials that may follow one another.
LEGAL = np.zeros((4, 4), bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True
#: Rows of a stretch.
CHUNK = 1 << 13
#: Characters of repaired text in a row between tasks.
PIECE = 1 << 16
INITIALS = "sua"
#: Faults of a row in the order they count.
FAULTS = ("none", "truncated", "duplicate", "blank")


def _steps(initial: int, fault: int) -> dict[tuple[int, int], tuple[int, str]]:
    """From state to state over one row: the cost and the edits. ``initial`` is a place in ``INITIALS`` or 3."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for begin in range(4):
        state, cost, edits = begin, 0, ""
        for _ in range(4):
            ends = [(state, COSTS["D"], "D")]
            if fault < 2:
                extra = TRUNCATED if fault else 0
                ends.append((NEXT[state], COSTS["R"] + extra, "R"))
                kept = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}.get((initial, state))
                if kept is not None:
                    ends.append((kept, COSTS["K"] + extra, "K"))
            for end, more, edit in ends:
                way = (cost + more, edits + edit)
                best[begin, end] = min(best.get((begin, end), way), way)
            state, cost, edits = NEXT[state], cost + COSTS["I"], edits + "I"
    return best


def _finish() -> dict[tuple[int, int], tuple[int, str]]:
    """Behind the last row: insertions up to an end. All ends are one exit, state 3."""
    best = {}
    for begin in range(4):
        state, edits = begin, ""
        while state not in FINAL:
            state, edits = NEXT[state], edits + "I"
        best[begin, 3] = (COSTS["I"] * len(edits), edits)
    return best


#: A symbol is ``4 * initial + fault``; the last one ends a conversation.
END = 16
_TABLES = [_steps(s // 4, s % 4) for s in range(END)] + [_finish()]
STEP_COST = np.full((END + 1, 4, 4), FAR)
STEP_RANK = np.zeros((END + 1, 4, 4), np.int8)
STEP_EDITS = [[[""] * 4 for _ in range(4)] for _ in range(END + 1)]
for _s, _table in enumerate(_TABLES):
    for (_x, _y), (_cost, _edits) in _table.items():
        STEP_COST[_s, _x, _y], STEP_EDITS[_s][_x][_y] = _cost, _edits
    for _x in range(4):
        _order = sorted({e for (x, _), (_, e) in _table.items() if x == _x})
        for _y in range(4):
            if (_x, _y) in _table:
                STEP_RANK[_s, _x, _y] = _order.index(_table[_x, _y][1])


def _meet(cost: np.ndarray, rank: np.ndarray, cost2: np.ndarray, rank2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs and ranks over two stretches, and the state between them, for each way from state to state.

    The rank of a way tells its place, by its edits, among those from the same state.
    """
    total = cost[:, :, :, None] + cost2[:, None, :, :]
    # Of the cheapest ways the one with the least edits on the left; equal edits lead to the same state.
    middle = (total * 4 + rank[:, :, :, None]).argmin(axis=2)
    least = np.minimum(np.take_along_axis(total, middle[:, :, None, :], 2)[:, :, 0, :], FAR)
    place = np.take_along_axis(rank, middle, 2) * 4 + np.take_along_axis(rank2, middle, 1)
    place = np.where(least < FAR, place, 99)
    order = (place[:, :, None, :] < place[:, :, :, None]).sum(axis=3).astype(np.int8)
    return least, order, middle.astype(np.int8)


class Stretches:
    """Stretches of rows, each in order: symbols, their sums, and the way through each of them.

    ``group`` ascends and numbers the stretches; ``ends`` tells for each whether its conversation ends there. Of a row
    with copies all but the first are duplicates or blank, so they are deleted; insertions between them come as late
    as they can, before the last one, as ``D`` is least. So the copies behind the first are one symbol of a higher cost.
    """

    def __init__(self, group: np.ndarray, initial: np.ndarray, fault: np.ndarray, copies: np.ndarray, ends: np.ndarray):
        row = np.repeat(np.arange(len(copies)), 1 + (copies > 1))
        again = np.append(False, row[1:] == row[:-1])[: len(row)]
        symbol = 4 * initial[row] + np.where(again & (fault[row] < 2), 2, fault[row])
        deleted, place = np.where(again, copies[row] - 2, 0), group[row]
        last = np.flatnonzero(ends)
        order = np.argsort(np.concatenate([place, last]), kind="stable")
        put = lambda values, end: np.concatenate([values, np.full(len(last), end, np.int64)])[order]
        self.row, self.symbol, self.deleted = put(row, -1), put(symbol, END), put(deleted, 0)
        self.sizes = np.bincount(np.concatenate([place, last]), minlength=len(ends))
        cost = STEP_COST[self.symbol] + COSTS["D"] * self.deleted[:, None, None]
        self._sum(np.minimum(cost, FAR), STEP_RANK[self.symbol], self.sizes)

    def _sum(self, cost: np.ndarray, rank: np.ndarray, sizes: np.ndarray) -> None:
        """Level by level: one row, two, four, … The odd one at the end of a stretch goes up as it is."""
        self.levels = []
        while len(cost) and sizes.max() > 1:
            of = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(cost)) - (np.cumsum(sizes) - sizes)[of]
            even = np.flatnonzero(place % 2 == 0)
            paired = place[even] + 1 < sizes[of[even]]
            left = even[paired]
            c, r, m = _meet(cost[left], rank[left], cost[left + 1], rank[left + 1])
            self.levels.append((len(cost), even, paired, m))
            cost, rank = cost[even], rank[even]
            cost[paired], rank[paired] = c, r
            sizes = (sizes + 1) // 2
        #: Of each stretch that has symbols.
        self.cost, self.rank = cost, rank

    @classmethod
    def of_sums(cls, cost: np.ndarray, rank: np.ndarray) -> Stretches:
        """One stretch of stretches that are summed up already."""
        self = cls.__new__(cls)
        self._sum(cost, rank, np.array([len(cost)]))
        return self

    def crossings(self, entry: np.ndarray, exit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States before and behind every symbol on the wanted ways: each stretch is halved where its halves meet."""
        before, behind = entry, exit
        for n, even, paired, middle in reversed(self.levels):
            start, stop = np.empty(n, np.int64), np.empty(n, np.int64)
            start[even], stop[even] = before, behind
            left = even[paired]
            state = middle[np.arange(len(left)), before[paired], behind[paired]]
            stop[left + 1], stop[left], start[left + 1] = behind[paired], state, state
            before, behind = start, stop
        return before, behind

    def repaired(self, entry: np.ndarray, exit: np.ndarray, roles: list[str], texts: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Of each stretch the edits and the repaired rows as ``role:text``."""
        used = self.sizes > 0
        before, behind = self.crossings(entry[used], exit[used])
        at, rows = 0, self.row.tolist()
        steps = zip(self.deleted.tolist(), self.symbol.tolist(), before.tolist(), behind.tolist())
        edits = [("D" * d if d else "") + STEP_EDITS[s][x][y] for d, s, x, y in steps]
        states = before.tolist()
        for size in self.sizes.tolist():
            lines: list[str] = []
            for i in range(at, at + size):
                row, state = rows[i], states[i]
                for step in edits[i]:
                    if step == "K":
                        lines.append(f"{roles[row]}:{texts[row]}")
                    elif step != "D":
                        state = NEXT[state]
                        lines.append(("assistant:" if state == 3 else "user:") + (texts[row] if step == "R" else ""))
            yield "".join(edits[at : at + size]), lines
            at += size


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of the rows with faults put into them by a hash of conversation and turn.

    A dropped row leaves one without copies, so that its conversation is still known.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20).alias("kind"),
    )
    gone, kind = F.col("kind") == 0, F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(text).alias("text"), F.when(gone, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def faulty(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with ``copies``, and its ``fault`` (a place in ``FAULTS``)."""
    key = ["conv_id", "turn", "role", "text"]
    rows = cut_lineage(rows.groupBy(*key).agg(F.sum("copies").alias("copies")), "rows")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    # Texts that occur at several turns; a null turn is the least.
    digest = F.sha2(F.concat_ws(":", "role", "text"), 256)
    seen = rows.filter((F.col("copies") > 0) & ~blank).select(F.col("conv_id").alias("c"), digest.alias("d"), "turn").groupBy("c", "d")
    seen = seen.agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = cut_lineage(seen.select("c", "d", F.col("first.turn").alias("first"), F.lit(True).alias("again")), "seen")
    joined = rows.withColumn("digest", digest).join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    later = F.coalesce("again", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    complete = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return joined.select(*key, "copies", F.when(blank, 3).when(later, 2).when(complete, 0).otherwise(1).alias("fault"))


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
ROW = ("turn", "role", "text", "copies", "fault")


class _Rows:
    """Whole stretches of a batch of rows, as arrays. Rows without copies only stand for their conversation."""

    def __init__(self, batch: pa.Table, group: np.ndarray):
        column = lambda name, kind: batch.column(name).to_numpy().astype(kind)
        copies = column("copies", np.int64)
        self.batch, self.used = batch, np.flatnonzero(copies > 0)
        self.n, self.group = int(group[-1]) + 1, group[self.used]
        self.copies, self.fault = copies[self.used], column("fault", np.int64)[self.used]
        first = pc.utf8_slice_codeunits(batch.column("role"), 0, 1)
        found = pc.fill_null(pc.index_in(first, pa.array(list(INITIALS))), 3)
        self.initial = found.to_numpy().astype(np.int64)[self.used]
        turn = batch.column("turn")
        self.dated = turn.is_valid().to_numpy()[self.used]
        self.turn = pc.fill_null(turn, 0).to_numpy()[self.used]

    def stretches(self, ends: bool | np.ndarray) -> Stretches:
        return Stretches(self.group, self.initial, self.fault, self.copies, np.broadcast_to(ends, self.n))

    def total(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.group, values, self.n).astype(np.int64)

    def figures(self) -> dict[str, np.ndarray]:
        """Sums of each stretch, and what is needed to join it with its neighbours; ``rows`` 0: only ``rows`` counts."""
        more = self.copies - 1
        near = np.append(self.group[1:] == self.group[:-1], False)[: len(self.group)]
        illegal = more + (near & ~LEGAL[self.initial, np.append(self.initial[1:], 0)[: len(near)]])
        begin, end = np.searchsorted(self.group, np.arange(self.n), "left"), np.searchsorted(self.group, np.arange(self.n), "right") - 1
        edge = lambda at: self.initial[np.clip(at, 0, max(len(self.initial) - 1, 0))] if len(self.initial) else np.zeros(self.n, np.int64)
        group, turn = self.group[self.dated], self.turn[self.dated]
        fresh = np.append(True, (group[1:] != group[:-1]) | (turn[1:] != turn[:-1]))[: len(turn)]
        low, high = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        low[group[::-1]], high[group] = turn[::-1], turn
        return {
            "rows": np.bincount(self.group, minlength=self.n), "first": edge(begin), "last": edge(end), "low": low, "high": high,
            "turns": np.bincount(group[fresh], minlength=self.n), "blank": self.total(self.copies * (self.fault == 3)),
            "duplicate": self.total((self.fault == 2) + more * (self.fault != 3)), "truncated": self.total(self.fault == 1), "illegal": self.total(illegal),
        }

    def texts(self) -> tuple[list[str], list[str]]:
        used = self.batch.take(pa.array(self.used))
        return used.column("role").to_pylist(), used.column("text").to_pylist()

    def names(self, group: np.ndarray, *columns: str) -> list[pa.Array]:
        """These columns of the first row of each stretch."""
        first = self.batch.take(pa.array(np.searchsorted(group, np.arange(self.n))))
        return [first.column(c).combine_chunks() for c in columns]


def _changes(batch: pa.RecordBatch, last: pa.RecordBatch | None, keys: list[str]) -> np.ndarray:
    """Whether each row begins a group; ``last`` is the row before the batch."""
    return ~same_key(batch, last, keys).to_numpy(zero_copy_only=False)


def _numbered(batches: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    return table, np.cumsum(_changes(table.to_batches()[0], None, keys)) - 1


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that hold whole groups, with the number of each row's group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = held[-1].slice(held[-1].num_rows - 1) if held else None
        cuts = np.flatnonzero(_changes(batch, last, keys))
        if len(cuts) and (held or cuts[-1]):
            yield _numbered([*held, batch.slice(0, cuts[-1])], keys)
            held = []
        held.append(batch.slice(cuts[-1]) if len(cuts) else batch)
    if held:
        yield _numbered(held, keys)


def _finished(table: pa.Table, group: np.ndarray) -> dict[str, pa.Array]:
    """Figures, edits and hash of whole conversations."""
    rows = _Rows(table, group)
    found = rows.figures()
    ways = rows.stretches(True)
    repaired = list(ways.repaired(np.zeros(rows.n, np.int64), np.full(rows.n, 3), *rows.texts()))
    found["gaps"] = np.where(found["turns"] > 0, found["high"] - found["low"] + 1 - found["turns"], 0)
    found["cost"] = ways.cost[:, 0, 3]
    out = {"conv_id": rows.names(group, "conv_id")[0], **{c: pa.array(found[c].astype(np.int64)) for c in FIGURES}}
    out["audit"] = pa.array([audit for audit, _ in repaired], pa.string())
    out["repaired_sha256"] = pa.array([hashlib.sha256("\n".join(lines).encode()).hexdigest() for _, lines in repaired], pa.string())
    return out


def _scan(rows: DataFrame, kind: str, chunk: int) -> DataFrame:
    """Conversations that lie inside a range are finished; the rows of those at its edges, and of long ones, go on.

    Rows that go on have ``stretch``, which ascends along a conversation and cuts it into at most ``chunk`` rows, and ``place``.
    """
    fields = [("turn", "bigint"), ("role", "string"), ("text", "string"), ("copies", "bigint"), ("fault", "int"), ("stretch", "bigint"), ("place", "bigint")]
    fields += [*[(c, "bigint") for c in FIGURES], ("audit", "string"), ("repaired_sha256", "string")]
    names = ["conv_id", *[n for n, _ in fields]]

    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, last = TaskContext.get().partitionId(), 0, None
        # Of the group that is going on: its rows so far, and whether it lies at the begin of the range or is long.
        held: list[pa.RecordBatch] = []
        edge = True

        def put(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            kinds = [last.schema.field("conv_id").type, *[types[k] for _, k in fields]]
            return pa.RecordBatch.from_arrays([columns[c].cast(k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names)

        def onward(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal place
            for batch in batches:
                at = np.arange(place, place + batch.num_rows)
                place += batch.num_rows
                columns = {"stretch": pa.array((part << 32) + at // chunk), "place": pa.array(at)}
                yield put({c: batch.column(c) for c in ("conv_id", *ROW)} | columns, batch.num_rows)

        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = np.flatnonzero(_changes(batch, last, ["conv_id"]))
            cuts = cuts[1:] if last is None else cuts
            last = batch.slice(batch.num_rows - 1)
            if len(cuts):
                held.append(batch.slice(0, cuts[0]))
                if edge:
                    yield from onward(held)
                    held = []
                inner = [b for b in [*held, batch.slice(cuts[0], cuts[-1] - cuts[0])] if b.num_rows]
                if inner:
                    table, group = _numbered(inner, ["conv_id"])
                    yield put(_finished(table, group), int(group[-1]) + 1)
                held, edge = [batch.slice(cuts[-1])], False
            else:
                held.append(batch)
            if edge or sum(b.num_rows for b in held) > chunk:
                yield from onward(held)
                held, edge = [], True
        yield from onward(held)

    return rows.mapInArrow(scan, f"conv_id {kind}, " + ", ".join(f"{n} {k}" for n, k in fields))


def _sums(rows: DataFrame, kind: str) -> DataFrame:
    """One row for each stretch: its figures, costs and ranks."""
    numbers = ("rows", "first", "last", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _whole(batches, ["stretch", "conv_id"]):
            found = _Rows(table, group)
            ways = found.stretches(False)
            used = found.figures()
            cost, rank = np.full((found.n, 16), FAR), np.zeros((found.n, 16), np.int64)
            cost[ways.sizes > 0], rank[ways.sizes > 0] = ways.cost.reshape(-1, 16), ways.rank.reshape(-1, 16)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(found.n + 1) * 16, pa.int32()), pa.array(x.ravel())) for x in (cost, rank)]
            columns = [*found.names(group, "conv_id", "stretch"), *[pa.array(used[c].astype(np.int64)) for c in numbers], *lists]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "stretch", *numbers, "cost", "rank"])

    schema = f"conv_id {kind}, stretch bigint, " + ", ".join(f"{c} bigint" for c in numbers) + ", cost array<bigint>, rank array<bigint>"
    narrow = rows.select("conv_id", "stretch", "place", "turn", F.substring("role", 1, 1).alias("role"), "copies", "fault")
    return narrow.repartition("stretch").sortWithinPartitions("stretch", "place").mapInArrow(summed, schema)


def _joined(parts: pd.DataFrame) -> pd.DataFrame:
    """The stretches of one conversation, in order: its figures on the last one, and the entry and exit of each."""
    parts = parts.sort_values("stretch", ignore_index=True)
    out = parts[["conv_id", "stretch"]].assign(entry=0, exit=0, ends=False, **dict.fromkeys(FIGURES, 0))
    used = np.flatnonzero(parts["rows"] > 0)
    if not len(used):
        out.loc[0, "ends"] = True
        out["exit"] = 3
        return out.iloc[:1]
    out, parts = out.iloc[used].reset_index(drop=True), parts.iloc[used].reset_index(drop=True)
    sums = [np.array(parts[c].tolist(), kind).reshape(-1, 4, 4) for c, kind in (("cost", np.int64), ("rank", np.int8))]
    ways = Stretches.of_sums(np.concatenate([sums[0], STEP_COST[END:]]), np.concatenate([sums[1], STEP_RANK[END:]]))
    entry, exit = ways.crossings(np.array([0]), np.array([3]))
    out["entry"], out["exit"] = entry[:-1], exit[:-1]
    last = len(out) - 1
    # The insertions behind the last row belong to the last stretch.
    out.loc[last, "exit"], out.loc[last, "ends"] = 3, True
    for c in ("blank", "duplicate", "truncated", "illegal"):
        out.loc[last, c] = parts[c].sum()
    first, end = parts["first"].to_numpy(), parts["last"].to_numpy()
    out.loc[last, "illegal"] += (~LEGAL[end[:-1], first[1:]]).sum()
    out.loc[last, "cost"] = ways.cost[0, 0, 3]
    dated = parts[parts["turns"] > 0]
    if len(dated):
        low, high = dated["low"].to_numpy(), dated["high"].to_numpy()
        out.loc[last, "gaps"] = high[-1] - low[0] + 1 - dated["turns"].sum() + (high[:-1] == low[1:]).sum()
    return out


def _rebuilt(rows: DataFrame, kind: str, piece: int) -> DataFrame:
    """Edits and repaired rows of each stretch between its entry and its exit, in rows of about ``piece`` characters."""

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _whole(batches, ["stretch", "conv_id"]):
            found = _Rows(table, group)
            conv, stretch, entry, exit, ends = found.names(group, "conv_id", "stretch", "entry", "exit", "ends")
            ways = found.stretches(ends.to_numpy(zero_copy_only=False))
            repaired = ways.repaired(entry.to_numpy().astype(np.int64), exit.to_numpy().astype(np.int64), *found.texts())
            for i, (audit, lines) in enumerate(repaired):
                pieces = list(_pieces(audit, lines, piece))
                columns = [
                    pa.concat_arrays([conv.slice(i, 1)] * len(pieces)), pa.concat_arrays([stretch.slice(i, 1)] * len(pieces)),
                    pa.array(range(len(pieces)), pa.int32()), pa.array([p[0] for p in pieces], pa.string()), pa.array([p[1] for p in pieces], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "stretch", "n", "audit", "lines"])

    return rows.mapInArrow(rebuilt, f"conv_id {kind}, stretch bigint, n int, audit string, lines string")


def _pieces(audit: str, lines: list[str], piece: int) -> Iterator[tuple[str, str | None]]:
    """Edits and lines in turn; a row of lines holds whole lines, or null where there is none."""
    held, size = [], 0
    for line in lines:
        held.append(line)
        size += len(line)
        if size >= piece:
            yield "", "\n".join(held)
            held, size = [], 0
    yield audit, "\n".join(held) if held else None


def _hashed(pieces: DataFrame, kind: str) -> DataFrame:
    """Of each conversation the edits put together, and one hash that goes on from piece to piece."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, digest, begun, id_type = None, [], None, False, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([key], id_type), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], ["conv_id", "audit", "repaired_sha256"]
            )

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, edits, lines in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "lines")]):
                if digest is None or conv != key:
                    if digest is not None:
                        yield done()
                    key, audit, digest, begun = conv, [], hashlib.sha256(), False
                audit.append(edits)
                if lines is not None:
                    digest.update((("\n" if begun else "") + lines).encode())
                    begun = True
        if digest is not None:
            yield done()

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "n").select("conv_id", "audit", "lines")
    return ordered.mapInArrow(put, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair(rows: DataFrame, chunk: int = CHUNK, piece: int = PIECE) -> DataFrame:
    """``conv_id``, the ``FIGURES``, ``audit`` and ``repaired_sha256`` of every conversation of ``conv_id, turn, role, text, copies``.

    ``chunk`` (rows) and ``piece`` (characters) bound what a task holds of a long conversation.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text"]
    dealt = faulty(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    scanned = cut_lineage(_scan(dealt, kind, chunk), "conversations")
    result = ["conv_id", *FIGURES, "audit", "repaired_sha256"]
    finished = scanned.filter("stretch IS NULL").select(*result)
    edges = scanned.filter("stretch IS NOT NULL").select("conv_id", "stretch", "place", *ROW)
    sums = _sums(edges, kind)
    plan_schema = f"conv_id {kind}, stretch bigint, entry bigint, exit bigint, ends boolean, " + ", ".join(f"{c} bigint" for c in FIGURES)
    # A conversation has one row for CHUNK of its own here.
    plan = cut_lineage(sums.groupBy("conv_id").applyInPandas(_joined, plan_schema), "crossings")
    asked = plan.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), "entry", "exit", "ends")
    here = edges.join(asked, (F.col("stretch") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c"))).drop("c", "s")
    pieces = _rebuilt(here.repartition("stretch").sortWithinPartitions("stretch", "place"), kind, piece)
    figures = plan.filter("ends").select(F.col("conv_id").alias("c"), *FIGURES)
    rest = _hashed(pieces, kind).join(figures, F.col("conv_id").eqNullSafe(F.col("c"))).select(*result)
    return finished.unionByName(rest)


SQL = r"""
WITH RECURSIVE bits AS (SELECT list(list_reduce([i] || range(8), lambda x, n: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) r(i)),
coded AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda c: ord(c)::BIGINT), lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, bits),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, substr(role, 1, 1) AS x, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM n),
g AS (SELECT *, lag(x) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM f),
figures AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'blank') AS blank,
    count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(y IS NOT NULL AND y || x NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
-- The best of each state: cost, edits, state (0 nothing, 1 s, 2 u, 3 a), repaired rows.
r AS (
  SELECT conv_id, 0::BIGINT AS i, [{'c': 0::BIGINT, 'e': '', 's': 0, 't': ''}] AS best FROM ids
  UNION ALL
  SELECT conv_id, i, list_filter(list_transform([0, 1, 2, 3], lambda y: list_min(list_filter(ways, lambda z: z.s = y))), lambda z: z IS NOT NULL) FROM (
    SELECT conv_id, i,
      list_transform(l, lambda z: {'c': z.c + 4, 'e': z.e || 'D', 's': z.s, 't': z.t})
      || list_transform(list_filter(l, lambda z: fault IN ('', 'truncated')), lambda z: {'c': z.c + 3 + extra, 'e': z.e || 'R',
        's': CASE WHEN z.s = 2 THEN 3 ELSE 2 END, 't': z.t || chr(10) || CASE WHEN z.s = 2 THEN 'assistant:' ELSE 'user:' END || text})
      || list_transform(list_filter(l, lambda z: fault IN ('', 'truncated') AND (x = 's' AND z.s = 0 OR x = 'u' AND z.s <> 2 OR x = 'a' AND z.s = 2)),
        lambda z: {'c': z.c + extra, 'e': z.e || 'K', 's': CASE x WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 't': z.t || chr(10) || role || ':' || text}) AS ways
    FROM (SELECT *, l0 || l1 || l2 || list_transform(l2, lambda z: {'c': z.c + 3, 'e': z.e || 'I', 's': CASE WHEN z.s = 2 THEN 3 ELSE 2 END,
        't': z.t || chr(10) || CASE WHEN z.s = 2 THEN 'assistant:' ELSE 'user:' END}) AS l
      FROM (SELECT *, list_transform(l1, lambda z: {'c': z.c + 3, 'e': z.e || 'I', 's': CASE WHEN z.s = 2 THEN 3 ELSE 2 END,
          't': z.t || chr(10) || CASE WHEN z.s = 2 THEN 'assistant:' ELSE 'user:' END}) AS l2
        FROM (SELECT r.conv_id, f.i, role, text, x, fault, (fault = 'truncated')::BIGINT * 3 AS extra, best AS l0,
            list_transform(best, lambda z: {'c': z.c + 3, 'e': z.e || 'I', 's': CASE WHEN z.s = 2 THEN 3 ELSE 2 END,
              't': z.t || chr(10) || CASE WHEN z.s = 2 THEN 'assistant:' ELSE 'user:' END}) AS l1
          FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1))))),
ended AS (SELECT conv_id, list_min(list_transform(best, lambda z: CASE z.s WHEN 1 THEN {'c': z.c + 6, 'e': z.e || 'II', 't': z.t || chr(10) || 'user:' || chr(10) || 'assistant:'}
    WHEN 2 THEN {'c': z.c + 3, 'e': z.e || 'I', 't': z.t || chr(10) || 'assistant:'} ELSE {'c': z.c, 'e': z.e, 't': z.t} END)) AS z
  FROM r QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
SELECT ended.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, z.c AS cost, z.e AS audit, sha256(substr(z.t, 2)) AS repaired_sha256
FROM ended LEFT JOIN figures ON figures.conv_id IS NOT DISTINCT FROM ended.conv_id
"""


@query("op12_conversation_repair", SQL)
def op12_conversation_repair(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations")))
