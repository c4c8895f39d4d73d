"""Pack documents into sequences by lexical retrieval.

Documents are dealt to shards of about ``shard_tokens`` tokens. A shard is an inverted index with BM25 weights over
the ids of whole documents, whose document frequencies are counted over the whole corpus. A document first fills
windows of its own; what is left of it is a seed. The index returns the seed's nearest unused neighbours, by all
terms of its document, and those that fit are taken whole, best first. If room is left, the best
remaining neighbour, or the next unused one if none shares a term, is cut to fill it. So every window is full
until a shard runs out; its last, partly filled window is cut into sequences of powers of two, which need no
padding.

A seed asks the shard it is in. Documents are dealt by their heaviest term, so that copies and documents about one thing
meet: terms in order of their id take shards of their own or share one; a term with more tokens than a shard holds has
several, over which its documents are dealt row by row. So a shard is bounded, apart from a single document that is
longer. ``neighbours`` asks all shards, exactly; README says how many of its answers a seed finds in its own.

Null texts are empty and consist of the end id alone. Repeated rows are documents of their own. Empty
tables give no rows, and extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tablerich.llm.common import query, table
from tablerich.llm.tokens import binaries, default_path, encoder
from tablerich.session import cut_lineage

WINDOW = 2048
K1, B = 1.2, 0.75


def tokenised(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, ids, n, heavy, place`` of every row, and rows with the document frequencies ``df`` of each task.

    ``ids`` are little-endian 16-bit; ``heavy`` is the heaviest of them, ``place`` a number of the row. The rows of
    frequencies have null ``ids``.
    """
    names = ["doc_id", "ids", "n", "heavy", "place", "df"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        df = np.zeros(max(coder.size, end_id + 1), np.int64)
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for ids, bounds in coder.encode_steps(batch.column("text"), end_id):
                n = len(bounds) - 1
                found, heavy = _terms(ids, bounds, len(df))
                df += found
                columns = [batch.column("doc_id").slice(at, n), binaries(ids, bounds), np.diff(bounds), heavy, np.arange(place, place + n), pa.nulls(n, kinds[5])]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                at, place = at + n, place + n
        yield pa.RecordBatch.from_arrays([*[pa.nulls(1, k) for k in kinds[:5]], pa.array([df], kinds[5])], names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id bigint, ids binary, n bigint, heavy int, place bigint, df array<bigint>")


def _terms(ids: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each id the number of texts that have it, and for each text its heaviest id.

    A byte-pair vocabulary has learnt rare tokens last, so here, where frequencies are not known yet, an id's weight is
    the logarithm of its number.
    """
    found, heavy = np.zeros(size, np.int64), []
    light = np.log1p(np.arange(size))
    for i in range(0, len(bounds) - 1, 1 << 16):
        some = bounds[i : i + (1 << 16) + 1]
        text = np.repeat(np.arange(len(some) - 1, dtype=np.uint32), np.diff(some))
        both = np.sort((text << np.uint32(16)) | ids[some[0] : some[-1]])
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
        term, tf = (both[first] & np.uint32(0xFFFF)).astype(np.int64), np.diff(np.append(first, len(both)))
        found += np.bincount(term, minlength=size)
        weight = light[term] * tf / (tf + K1)
        owner = (both[first] >> np.uint32(16)).astype(np.int64)
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)])
        best = np.repeat(np.maximum.reduceat(weight, begin), np.diff(np.append(begin, len(owner)))) if len(begin) else weight
        at = np.flatnonzero(weight == best)
        # Of equal weights the first; every text has an id, its end at least.
        heavy.append(term[at[np.searchsorted(owner[at], np.arange(len(some) - 1))]])
    return found, np.concatenate(heavy) if heavy else np.zeros(0, np.int64)


class Index:
    """A BM25 index over some runs of token ids, asked with all terms of one of them.

    Terms of many runs hold a weight for each run, so that they are added as columns; the others have postings.
    """

    def __init__(self, runs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.terms, self.weights, self.vocabulary = [], [], len(idf)
        for run in runs:
            term, tf = np.unique(run, return_counts=True)
            self.terms.append(term)
            self.weights.append(idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(run) / mean_length)))
        self.keep(np.arange(len(runs)))

    def keep(self, members: np.ndarray) -> None:
        """Score the runs ``members`` only; terms that none of them has cost nothing."""
        self.members = members
        n = len(members)
        term = np.concatenate([self.terms[m] for m in members])
        owner = np.repeat(np.arange(n), [len(self.terms[m]) for m in members])
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = owner[order], np.concatenate([self.weights[m] for m in members])[order]
        self.first = np.searchsorted(term[order], np.arange(self.vocabulary + 1))
        # At most four times the postings.
        often = np.flatnonzero(np.diff(self.first) * 4 > n)
        self.row = np.full(self.vocabulary, -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), n))
        for row, t in enumerate(often):
            span = slice(self.first[t], self.first[t + 1])
            self.dense[row, self.owner[span]] = self.weight[span]

    def scores(self, run: int) -> np.ndarray:
        """Of every member, its weight for the terms of ``run``."""
        return self._add(self.terms[run])

    def ask(self, ids: np.ndarray) -> np.ndarray:
        """The same for any ids."""
        return self._add(np.unique(ids))

    def _add(self, terms: np.ndarray) -> np.ndarray:
        rows = self.row[terms]
        few = terms[rows < 0]
        spans = [slice(a, b) for a, b in zip(self.first[few], self.first[few + 1]) if a < b]
        found = np.zeros(len(self.members))
        if spans:
            found = np.bincount(
                np.concatenate([self.owner[s] for s in spans]),
                weights=np.concatenate([self.weight[s] for s in spans]), minlength=len(self.members),
            )
        for row in rows[rows >= 0]:
            found += self.dense[row]
        return found


def pack_shard(
    lengths: list[int], ids: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW
) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of a shard of documents with all their ``ids``."""
    pieces = []
    sequence = 0
    for d, n in enumerate(lengths):
        for start in range(0, n - n % window, window):
            pieces.append((d, start, window, sequence, 0))
            sequence += 1
    left = [d for d, n in enumerate(lengths) if n % window]
    if not left:
        return pieces
    index = Index([ids[d] for d in left], idf, mean_length)
    rest = np.array([lengths[d] % window for d in left])
    begin = np.array([lengths[d] for d in left]) - rest
    unused = np.ones(len(left), bool)
    # Long seeds first: short documents are what fills their windows.
    queue = np.argsort(-rest, kind="stable")
    spare = 0

    def take(i: int, length: int, offset: int) -> None:
        pieces.append((left[i], int(begin[i]), int(length), sequence, int(offset)))
        begin[i] += length
        rest[i] -= length
        unused[i] = rest[i] > 0

    for seed in queue:
        if not unused[seed]:
            continue
        filled = int(rest[seed])
        take(seed, filled, 0)
        if filled < window:
            if 2 * int(unused.sum()) < len(index.members) and unused.any():
                index.keep(np.flatnonzero(unused))
            near = index.members
            scores = index.scores(int(seed))
            scores[~unused[near]] = 0
            while filled < window:
                fits = np.where(rest[near] <= window - filled, scores, 0)
                best = int(fits.argmax())
                if not fits[best]:
                    break
                i = int(near[best])
                size = int(rest[i])
                take(i, size, filled)
                scores[best] = 0
                filled += size
            while filled < window:
                best = int(scores.argmax())
                if scores[best]:
                    i = int(near[best])
                    scores[best] = 0
                else:
                    while spare < len(queue) and not unused[queue[spare]]:
                        spare += 1
                    if spare == len(queue):
                        break
                    i = int(queue[spare])
                size = min(int(rest[i]), window - filled)
                take(i, size, filled)
                filled += size
        if filled == window:
            sequence += 1
            continue
        # The shard has run out: powers of two, largest first.
        last = [p for p in pieces if p[3] == sequence]
        del pieces[len(pieces) - len(last) :]
        sizes = [1 << b for b in reversed(range(window.bit_length())) if filled >> b & 1]
        at = 0
        for d, start, length, _, _ in last:
            while length:
                room = sizes[0] - at
                cut = min(room, length)
                pieces.append((d, start, cut, sequence, at))
                start, length, at = start + cut, length - cut, at + cut
                if at == sizes[0]:
                    sizes, at, sequence = sizes[1:], 0, sequence + 1
    return pieces


def dealt_terms(sizes: list[tuple[int, int]], shard_tokens: int) -> list[tuple[int, int, int]]:
    """``(term, first shard, number of shards)``: light terms share a shard in a row, a heavy one has several."""
    out, shard, held = [], 0, 0
    for term, n in sizes:
        if held and held + n > shard_tokens:
            shard, held = shard + 1, 0
        many = max(1, -(-n // shard_tokens))
        out.append((term, shard, many))
        if many > 1:
            shard, held = shard + many, 0
        else:
            held += n
    return out


def neighbours(
    docs: DataFrame, k: int = 5, tokenizer: str | None = None, end_id: int = 1, shard_tokens: int = 2 << 20
) -> DataFrame:
    """``place, near, score``: for each row the ``k`` best others of the corpus by BM25 over all terms.

    Every row asks every shard, so this takes the product of both; ``pack`` does not use it.
    """
    rows = cut_lineage(tokenised(docs, tokenizer or default_path(), end_id), "tokenised")
    idf, mean_length, n_tokens = _statistics(rows)
    shards = max(1, -(-n_tokens // shard_tokens))
    runs = rows.filter("ids IS NOT NULL").select("place", "ids")
    dealt = runs.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards))).withColumn("kind", F.lit(0))
    asked = runs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>"))).withColumn("kind", F.lit(1))
    met = dealt.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, index, held = None, None, []
        for batch in batches:
            for r in batch.itertuples():
                ids = np.frombuffer(r.ids, "<u2")
                if r.kind == 0:
                    if r.shard != shard:
                        shard, index, held = r.shard, None, []
                    held.append((r.place, ids))
                    continue
                if r.shard != shard:
                    continue
                if index is None:
                    index, places = Index([ids_ for _, ids_ in held], idf, mean_length), np.array([p for p, _ in held])
                scores = index.ask(ids)
                scores[places == r.place] = 0
                best = np.argsort(-scores, kind="stable")[:k]
                best = best[scores[best] > 0]
                yield pd.DataFrame({"place": np.full(len(best), r.place), "near": places[best], "score": scores[best]})

    found = met.mapInPandas(search, "place bigint, near bigint, score double")
    order = Window.partitionBy("place").orderBy(F.desc("score"), "near")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def _statistics(rows: DataFrame) -> tuple[np.ndarray, float, int]:
    """Weights of the ids, mean length and number of tokens of ``tokenised`` rows."""
    counted = rows.agg(F.count("n"), F.sum("n")).first()
    n_docs, n_tokens = int(counted[0]), int(counted[1] or 0)
    # One number for each id of the vocabulary.
    per_id = rows.filter("df IS NOT NULL").select(F.posexplode("df")).groupBy("pos").agg(F.sum("col").alias("df")).collect()
    df = np.zeros(1 + max([r["pos"] for r in per_id], default=0))
    for r in per_id:
        df[r["pos"]] = r["df"]
    return np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32), n_tokens / max(1, n_docs), n_tokens


def pack(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = WINDOW, shard_tokens: int = 2 << 20,
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece, and its ``ids``."""
    rows = cut_lineage(tokenised(docs, tokenizer or default_path(), end_id), "tokenised")
    idf, mean_length, _ = _statistics(rows)
    # One number for each id of the vocabulary.
    heavy = rows.filter("ids IS NOT NULL").groupBy("heavy").agg(F.sum("n").alias("n")).orderBy("heavy").collect()
    shards = rows.sparkSession.createDataFrame(dealt_terms([(r["heavy"], int(r["n"])) for r in heavy], shard_tokens), "term int, first bigint, many bigint")

    def fill(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.assign(crc=[zlib.crc32(i) for i in shard["ids"]]).sort_values(["doc_id", "n", "crc"], kind="stable")
        ids = [np.frombuffer(i, "<u2") for i in shard["ids"]]
        lengths = [len(i) for i in ids]
        names = pd.arrays.IntegerArray(shard["doc_id"].to_numpy("int64"), shard["unknown"].to_numpy(bool))
        found = pack_shard(lengths, ids, idf, mean_length, window)
        d, start, length, sequence, offset = map(np.array, zip(*found))
        parts = [ids[i][a : a + n].astype("<u4").tobytes() for i, a, n in zip(d, start, length)]
        out = pd.DataFrame(
            {
                "doc_id": names[d], "start": start, "length": length,
                "ids_crc32": [zlib.crc32(p) for p in parts], "doc_tokens": [lengths[i] for i in d],
                "sequence_id": sequence + (int(shard["shard"].iloc[0]) << 32), "offset": offset,
            }
        )
        return out.assign(ids=parts) if with_ids else out

    owner = F.col("first") + F.pmod(F.xxhash64("doc_id", "n", "place"), F.col("many"))
    # At most a row for each id of the vocabulary.
    dealt = rows.filter("ids IS NOT NULL").join(F.broadcast(shards), F.col("heavy") == F.col("term")).select(
        F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("doc_id").isNull().alias("unknown"), "ids", "n", owner.alias("shard")
    )
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("shard").applyInPandas(fill, schema + ", ids binary" * with_ids)


@query("op5_packing")
def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
