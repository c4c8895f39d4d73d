"""Memory of past runs: scoped retrieval, eviction and clearing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.operators.index import StoredIndex
from tablerich.operators.search import Corpus, rank_documents

# Fixed values.
KINDS = ("task", "monitor", "discovery")
MAX_QUERY_CHARS = 500
MAX_RESULTS = 25
IDENTIFIER = r"[a-zA-Z0-9_-]{1,128}"


def check_identifier(value: str, field: str) -> str:
    if not re.fullmatch(IDENTIFIER, value):
        raise ValueError(f"{field}: letters, digits, _ and - only, 1 to 128 of them")
    return value


def parse_since(value: str | datetime) -> datetime:
    """A moment with an offset; one without is refused."""
    try:
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
    except ValueError as exc:
        raise ValueError(f"since is no timestamp: {value!r}") from exc
    if moment.utcoffset() is None:
        raise ValueError("since needs a time zone")
    return moment


def filter_entries(
    entries: DataFrame, *, kinds: Sequence[str] | None = None, since: str | datetime | None = None,
    scope: str | None = None, updated: str = "updated_at",
) -> DataFrame:
    if kinds:
        wrong = set(kinds) - set(KINDS)
        if wrong:
            raise ValueError(f"unknown kinds: {sorted(wrong)}")
        entries = entries.filter(F.col("kind").isin(*kinds))
    if since is not None:
        entries = entries.filter(F.col(updated) >= F.lit(parse_since(since)))
    if scope is not None:
        entries = entries.filter(F.col("scope") == check_identifier(scope, "scope"))
    return entries


def _check_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_RESULTS:
        raise ValueError(f"limit must be from 1 to {MAX_RESULTS}")
    return limit


def recent(entries: DataFrame, limit: int = 10, updated: str = "updated_at") -> DataFrame:
    """The newest entries."""
    return entries.orderBy(F.desc(updated), "scope", "id").limit(_check_limit(limit))


def recent_per_scope(entries: DataFrame, limit: int = 10, updated: str = "updated_at") -> DataFrame:
    """The newest entries of every scope, with their ``rank``.

    Spark cuts each task's rows of a scope to ``limit`` before the shuffle, so a large scope is cheap.
    """
    newest = Window.partitionBy("scope").orderBy(F.desc(updated), "id")
    return entries.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= _check_limit(limit))


def relevant(entries: DataFrame, query: str, text: str, limit: int = 10) -> DataFrame:
    """Entries by BM25 relevance to ``query``; ties by scope, kind and id."""
    if len(query) > MAX_QUERY_CHARS:
        raise ValueError(f"query must have at most {MAX_QUERY_CHARS} characters")
    corpus = Corpus(entries, ("scope", "kind", "id"), text)
    return rank_documents(corpus, [query], limit=_check_limit(limit)).drop("query_no")


@dataclass(frozen=True)
class MemoryIndex:
    """Entries in a stored index, for memories that are searched often: no call reads their texts again.

    New entries add a segment, evicted and cleared ones are marked; results are those of ``relevant`` on what is left.
    """

    index: StoredIndex

    @classmethod
    def build(cls, entries: DataFrame, text: str, path: str, updated: str = "updated_at", unique: bool = False) -> MemoryIndex:
        return cls(StoredIndex.build(Corpus(entries, ("scope", "kind", "id"), text, unique=unique), path, kept=(updated,)))

    def add(self, entries: DataFrame, text: str) -> None:
        self.index.add(entries, text)

    def relevant(self, query: str, limit: int = 10) -> DataFrame:
        if len(query) > MAX_QUERY_CHARS:
            raise ValueError(f"query must have at most {MAX_QUERY_CHARS} characters")
        return self.index.rank_keys([query], limit=_check_limit(limit)).drop("query_no")

    def evict(self, evicted: DataFrame) -> None:
        """Entries named by ``(scope, kind, id)``."""
        self.index.remove(evicted)

    def clear(self, cleared: DataFrame) -> None:
        """Entries that are not newer than the last clearing of their scope (``scope, cleared_at``)."""
        (updated,) = self.index.kept
        last = cleared.groupBy("scope").agg(F.max("cleared_at").alias("_at")).hint("rebalance")
        self.index.remove_rows(self.index.documents().join(last, "scope").filter(F.col(updated) <= F.col("_at")))

    def compact(self) -> None:
        self.index.compact()


def evict(entries: DataFrame, evicted: DataFrame) -> DataFrame:
    """Entries not named by a ``(scope, kind, id)`` tombstone."""
    return entries.join(evicted.select("scope", "kind", "id"), ["scope", "kind", "id"], "left_anti")


def clear(entries: DataFrame, cleared: DataFrame, updated: str = "updated_at") -> DataFrame:
    """Entries newer than the last clearing of their scope (``scope, cleared_at``)."""
    # Dealt out once more, so that a scope with very many entries can be split between tasks.
    last = cleared.groupBy("scope").agg(F.max("cleared_at").alias("_at")).hint("rebalance")
    joined = entries.join(last, "scope", "left")
    return joined.filter(F.col("_at").isNull() | (F.col(updated) > F.col("_at"))).select(*entries.columns)


def preview(kind: Column, output: Column, matched: Column, status: Column) -> Column:
    """One line per entry: task output, number of matched entities, or monitor status."""
    return (
        F.when(kind == "task", output)
        .when(kind == "discovery", F.concat(F.lit("Matched entities: "), F.coalesce(matched, F.lit(0)).cast("string")))
        .when(kind == "monitor", F.concat(F.lit("Status: "), F.coalesce(status, F.lit("unknown"))))
    )


def preview_rows(entries: DataFrame) -> DataFrame:
    """Preview lines; a monitor entry gives one row per matched event."""
    events = F.explode_outer(F.when(F.col("kind") == "monitor", F.col("matched_events"))).alias("event")
    line = preview(F.col("kind"), F.col("output_excerpt"), F.col("matched_count"), F.col("status"))
    return entries.select("scope", "kind", "id", "updated_at", "input_excerpt", line.alias("line"), events).select(
        "scope", "kind", "id", "updated_at", "input_excerpt", "line", "event.event_id", "event.detected_at", "event.excerpt"
    )
