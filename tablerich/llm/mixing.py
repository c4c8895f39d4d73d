"""Mix sources to target weights in fixed-length blocks.

The words of a source, its documents in order of ``doc_id``, are packed into blocks of ``block_words``. The mix is
a number of slots in output shards, each slot one block. Source counts of a shard are multinomial draws,
conditioned on the totals: a tree over the shards splits the totals of its root, at each node by a
multivariate hypergeometric draw, so every task finds the counts of its own shards alone and all shards add
up to the targets. The k-th slot of a source takes block ``permutation(k mod blocks)``, a seeded
permutation of its own for each pass over the source, and slots and blocks are joined by index. The last
slot of a source is trimmed, so a source gives its target to the word.

Null texts and texts without words are of size 0 and are never taken. Null sources are one source, the last
in order. Repeated rows are documents of their own. An empty table gives no rows, and extra columns are ignored. One
number for each source is handled on the driver, rows of documents never are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.llm.common import WORD, query, table, text_of
from tablerich.operators.ordering import running_totals
from tablerich.session import cut_lineage


def targets(sizes: dict[str | None, int], weights: Sequence[float], cap: float = 3.0) -> dict[str | None, float]:
    """Words of each source: shares of the total by weight, none above ``cap`` times its size.

    Weights repeat over the sources in code point order, null last. What a source gives up at its cap is shared
    among the others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total = float(sum(sizes.values()))
    capped: dict[str | None, float] = {}
    while True:
        open_ = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        shared = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / shared for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {s: capped[s] if s in capped else share[s] for s in order}
        capped |= {s: cap * float(sizes[s]) for s in over}


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int, inverse: bool = False, rounds: int = 6) -> np.ndarray:
    """A pseudorandom permutation of ``0..n-1``: a Feistel network, walked until it is below ``n``."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    keys = [np.uint64(k) for k in np.random.SeedSequence(key).generate_state(rounds, np.uint64)]

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        with np.errstate(over="ignore"):
            for k in reversed(keys) if inverse else keys:
                if inverse:
                    left, right = right ^ (_mix64(left + k) & low), left
                else:
                    left, right = right, left ^ (_mix64(right + k) & low)
        return (left << half) | right

    x = network(np.asarray(index).astype(np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = network(x[out])
    return x.astype(np.int64)


@dataclass(frozen=True)
class Source:
    """A source in the mix: its words, the words to take, and what follows from them."""

    name: str | None
    number: int
    size: int
    take: int
    block: int
    seed: int

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block)

    @property
    def tail(self) -> int:
        """Words in the last block."""
        return self.size - (self.blocks - 1) * self.block

    def key(self, epoch: int) -> int:
        return hash((self.seed, self.number, epoch)) & 0x7FFFFFFFFFFFFFFF

    @property
    def _last(self) -> tuple[int, int, int]:
        """Whole passes; slots of the last pass; the slot of that pass that holds the short block."""
        passes, rest = divmod(self.take, self.size)
        short = int(permute(np.array([self.blocks - 1]), self.blocks, self.key(passes), inverse=True)[0])
        if rest <= short * self.block:
            return passes, -(-rest // self.block), short
        return passes, -(-(rest + self.block - self.tail) // self.block), short

    @property
    def slots(self) -> int:
        if not self.take:
            return 0
        passes, more, _ = self._last
        return passes * self.blocks + more

    def blocks_of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pass, block index and words taken of the source's slots."""
        passes, _, short = self._last
        epoch, place = np.divmod(slots, self.blocks)
        index = np.empty(len(slots), np.int64)
        for e in np.unique(epoch):
            index[epoch == e] = permute(place[epoch == e], self.blocks, self.key(int(e)))
        words = np.where(index == self.blocks - 1, self.tail, self.block)
        begun = place * self.block - np.where(place > short, self.block - self.tail, 0)
        rest = self.take - passes * self.size
        return epoch, index, np.where(epoch < passes, words, np.minimum(words, rest - begun))


def _log_ratio(a: int, b: int) -> float:
    """``ln(a! / b!)``; by Stirling's series where the factorials themselves would lose the difference."""
    if min(a, b) < 1000:
        return math.lgamma(a + 1) - math.lgamma(b + 1)
    return (b + 0.5) * math.log1p((a - b) / b) + (a - b) * math.log(a) - (a - b) + (1 / a - 1 / b) / 12


def hypergeometric(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of ``n`` drawn without replacement are good; one rule whatever the numbers.

    The ratio of uniforms with the table-free hat of Stadlober; the few draws of a small sample are made one by one.
    """
    total = good + bad
    m = min(n, total - n)
    if m <= 10:
        left, found = good, 0
        for i in range(m):
            hit = int(rng.integers(total - i)) < left
            left, found = left - hit, found + hit
        return found if m == n else good - found
    few, many = min(good, bad), max(good, bad)
    share = few / total
    mean = m * share + 0.5
    deviation = math.sqrt((total - m) / (total - 1) * m * share * (1 - share) + 0.5)
    hat = math.sqrt(8 / math.e) * deviation + (3 - 2 * math.sqrt(3 / math.e))
    mode = (m + 1) * (few + 1) // (total + 2)
    end = min(min(m, few) + 1, math.floor(mean + 16 * deviation))
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        w = mean + hat * (v - 0.5) / u
        if not 0 <= w < end:
            continue
        k = int(w)
        t = _log_ratio(mode, k) + _log_ratio(few - mode, few - k) + _log_ratio(m - mode, m - k) + _log_ratio(many - m + mode, many - m + k)
        if 2 * math.log(u) <= t:
            break
    if good > bad:
        k = m - k
    return k if m == n else good - k


def _split(quotas: list[int], n: int, rng: np.random.Generator) -> list[int]:
    """Of ``sum(quotas)`` slots the counts of the first ``n``: a multivariate hypergeometric draw, source by source."""
    rest, counts = sum(quotas), []
    for quota in quotas:
        rest -= quota
        counts.append(hypergeometric(quota, rest, n, rng))
        n -= counts[-1]
    return counts


def shard_counts(quotas: list[int], shard_slots: int, shard: int, seed: int) -> tuple[list[int], list[int]]:
    """Of each source the slots before ``shard`` and the slots in it."""
    before, here = [0] * len(quotas), list(quotas)
    first, last = 0, -(-sum(quotas) // shard_slots)
    while last - first > 1:
        middle = (first + last) // 2
        left = _split(here, (middle - first) * shard_slots, np.random.default_rng([seed, first, last]))
        if shard < middle:
            here, last = left, middle
        else:
            before = [b + x for b, x in zip(before, left)]
            here, first = [h - x for h, x in zip(here, left)], middle
    return before, here


def measured(docs: DataFrame) -> DataFrame:
    """Of each row ``doc_id, source, size`` and a digest of its text."""
    return docs.select(
        "doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64("text").alias("digest"),
    )


class Mix:
    """A mix of ``docs`` (``doc_id, text, source``)."""

    def __init__(
        self,
        docs: DataFrame,
        weights: Sequence[float] = (5, 2, 1),
        cap: float = 3.0,
        block_words: int = 1024,
        shard_slots: int = 1024,
        seed: int = 20,
    ):
        self.spark, self.docs, self.block, self.shard_slots, self.seed = docs.sparkSession, docs, block_words, shard_slots, seed
        rows = cut_lineage(measured(docs), "sizes")
        per_source = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
        sizes = {r["source"]: int(r["size"]) for r in per_source}
        self.target = targets(sizes, weights, cap) if sizes else {}
        self.sources = [
            Source(s, i, sizes[s], min(round(self.target[s]), int(cap * sizes[s])), block_words, seed)
            for i, s in enumerate(self.target)
        ]
        plan = pd.DataFrame(
            {"source": list(self.target), "source_size": [s.size for s in self.sources], "target": list(self.target.values())}
        ).astype({"source": object, "source_size": "int64", "target": float})
        self.plan = self.spark.createDataFrame(
            list(plan.itertuples(index=False, name=None)), "source string, source_size bigint, target double"
        )
        # The end of each document in its source; a source may be spread over many tasks.
        ended = running_totals(
            rows.withColumn("end", F.col("size")), ["source"], ["doc_id", "size", "digest"], ["end"]
        )
        self.rows = ended.withColumn("start", F.col("end") - F.col("size"))

    def slots(self) -> DataFrame:
        """``shard, slot, source, epoch, block, words``: a row for each slot of the mix."""
        sources, per, seed = [s for s in self.sources if s.slots], self.shard_slots, self.seed
        quotas = [s.slots for s in sources]
        shards = -(-sum(quotas) // per)

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for shard in batch["id"]:
                    before, here = shard_counts(quotas, per, int(shard), seed)
                    found = []
                    for s, first, n in zip(sources, before, here):
                        epoch, block, words = s.blocks_of(np.arange(first, first + n))
                        found.append(pd.DataFrame({"source": s.name, "epoch": epoch, "block": block, "words": words}))
                    rows = pd.concat(found)
                    rows.insert(0, "slot", np.random.default_rng([seed, 1, int(shard)]).permutation(len(rows)))
                    rows.insert(0, "shard", shard)
                    yield rows.astype({"source": object})

        schema = "shard bigint, slot bigint, source string, epoch bigint, block bigint, words bigint"
        tasks = max(1, min(shards, self.spark.sparkContext.defaultParallelism * 4))
        return self.spark.range(0, shards, 1, tasks).mapInPandas(draw, schema)

    def pieces(self) -> DataFrame:
        """Parts of documents in the mix: the rows of ``slots`` with ``doc_id, size, digest, start`` and ``first, taken``.

        ``first`` counts the words of the document before the part, ``taken`` those in it.
        """
        b = self.block
        spans = self.rows.filter("size > 0").withColumn(
            "block", F.explode(F.sequence(F.expr(f"start div {b}"), F.expr(f"(end - 1) div {b}")))
        )
        slots = self.slots().withColumnsRenamed({"source": "_source", "block": "_block"})
        # The size of drawn slots is unknown to the planner, and grows with the corpus: they are never broadcast.
        joined = spans.join(
            slots.hint("merge"),
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")),
        )
        begins = F.greatest(F.col("start"), F.col("block") * b)
        ends = F.least(F.col("end"), F.col("block") * b + F.col("words"))
        return (
            joined.withColumns({"first": begins - F.col("start"), "taken": ends - begins})
            .filter("taken > 0")
            .drop("_source", "_block", "words")
        )

    def report(self) -> DataFrame:
        """One row for each document: ``doc_id, size, source_size, target, taken``."""
        taken = (
            self.pieces().groupBy("source", "start").agg(F.sum("taken").alias("taken"))
            .withColumnsRenamed({"source": "_source", "start": "_start"})
        )
        # An empty document begins where the next one does.
        same = (F.col("size") > 0) & (F.col("start") == F.col("_start")) & F.col("source").eqNullSafe(F.col("_source"))
        rows = self.rows.join(taken, same, "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
        plan = self.plan.withColumnRenamed("source", "_s")
        return rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).select(
            "doc_id", "size", "source_size", "target", "taken"
        )

    def documents(self) -> DataFrame:
        """The mix as documents: for each pass over a document a row with the text of its parts, in order.

        A document taken twice has two rows. A part reaches from its first word to the next part's, white
        space included; ``n_chars`` is that of the new text. Other columns are those of the document.
        """
        parts = (
            self.pieces().groupBy("source", "start", "epoch", "doc_id", "size", "digest")
            .agg(F.array_sort(F.collect_list(F.struct("first", "taken"))).alias("parts"))
        )
        # Equal rows are paired by their number.
        numbered = Window.partitionBy("doc_id", "digest").orderBy("source", "start")
        chosen = parts.select("doc_id", "digest", F.dense_rank().over(numbered).alias("copy"), "size", "parts")
        fields = self.docs.columns
        names = [f"c{i}" for i in range(len(fields))]
        texts = self.docs.select(
            *[F.col(f"`{c}`").alias(n) for c, n in zip(fields, names)],
            F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.col("source").alias("of"),
        ).withColumn("row", F.row_number().over(Window.partitionBy("id", "hash").orderBy("of")))
        joined = texts.join(
            chosen,
            F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("digest"))
            & (F.col("row") - F.col("copy") == 0),  # no key of the join: the texts stay where the window has put them
        )
        schema = self.docs.schema

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {f: batch.column(n) for f, n in zip(fields, names)}
                whole = zip(columns["text"], batch.column("size"), batch.column("parts"))
                text = [_parts_of(t.as_py(), n.as_py(), p.as_py()) for t, n, p in whole]
                columns["text"] = pa.array(text, columns["text"].type)
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([len(t) for t in text]).cast(columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), fields)

        return joined.select(*names, "size", "parts").mapInArrow(cut, schema)


def _parts_of(text: str, size: int, parts: Sequence) -> str:
    whole = [(int(p["first"]), int(p["taken"])) for p in parts]
    at = 0
    for first, taken in whole:
        if first != at:
            break
        at += taken
    if at == size:
        return text
    begins = word_starts(text)
    begins = np.append(begins, len(text.encode()))
    raw = text.encode()
    return b"".join(raw[begins[f] : begins[f + n]] for f, n in whole).decode()


def word_starts(text: str) -> np.ndarray:
    """Byte offsets of the words of a text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    return np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))


@query("op6_mixing")
def op6_mixing(spark, sf_dir):
    return Mix(table(spark, sf_dir, "documents")).report()
