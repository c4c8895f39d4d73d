"""A stored BM25 index that grows: for corpora that are searched often, or by a table of queries.

Documents are numbered row by row, so that rows which share a key stay apart, and lie in blocks of ``BLOCK`` rows. For
each word of a block there is one row: where it occurs, how often, and the most occurrences and the shortest document
among them, from which follows the most the word can add to a score there, whatever the averages of the corpus
become. The rows of a frequent word are as many as its blocks, so no task holds all of it.

A search adds up these bounds for each query and block, scores the blocks of the highest bounds first, and then only
blocks whose bound reaches the score of the query's last result so far. No text is read.

The index consists of segments. ``add`` writes the words of the new documents and nothing else; ``remove`` writes the
rows that are gone and what each of their words loses; statistics are those of all segments together, less what is
gone. ``compact`` writes one segment without the removed rows. A segment counts once its totals are written, which is
the last step, so that a write that fails half way changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tablerich.operators.ordering import number_rows
from tablerich.operators.search import B, DEFAULT_RESULTS, K1, MAX_RESULTS, Corpus, request_terms, tokens
from tablerich.session import cut_lineage

#: Documents of a block; places within it fit a few bits.
BLOCK = 64
#: Words that a task takes at once when documents are added; a block is never cut.
STEP = 1 << 18
#: Blocks of a query up to which each wave scores; a last one takes all that can still matter.
WAVES = (32,)
#: More than sums of the same numbers in another order can differ.
SLACK = 1e-5
# A row number: segment, task of the writing job, document of the task.
_TASK_BITS, _ROW_BITS = 20, 27

_BLOCKS = "term string, block bigint, place array<int>, tf array<int>, len array<int>, n int, most_tf int, least_len int"
_TOTALS = "docs bigint, words bigint, retires array<int>"


def _weight(tf: Column, length: Column, mean: float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(float(mean))))


def _term_counts(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each word of each document: its number, the document, its count; by word, then document. And the words."""
    flat = words.flatten().dictionary_encode()
    n = max(1, len(words))
    doc = np.repeat(np.arange(len(words)), np.diff(words.offsets.to_numpy()))
    both, tf = np.unique(flat.indices.to_numpy().astype(np.int64) * n + doc, return_counts=True)
    return both // n, both % n, tf, flat.dictionary


def _steps(batch: pa.RecordBatch, column: str, step: int) -> Iterator[pa.RecordBatch]:
    """Whole blocks of the rows of a batch, of about ``step`` words or of one block with more."""
    n, offsets = batch.num_rows, batch.column(column).offsets.to_numpy()
    at = 0
    for end in [*range(BLOCK, n, BLOCK), n]:
        # The block after this one would go beyond the step.
        if end == n or offsets[min(end + BLOCK, n)] - offsets[at] > step:
            yield batch.slice(at, end - at)
            at = end


@dataclass(frozen=True)
class StoredIndex:
    """The words of a corpus below ``path``; ``keys`` name a document, ``kept`` are columns stored beside them."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    unique: bool = False
    kept: tuple[str, ...] = ()

    @classmethod
    def build(cls, corpus: Corpus, path: str, kept: Sequence[str] = ()) -> StoredIndex:
        """A new index of a corpus."""
        index = cls(corpus.df.sparkSession, path, tuple(corpus.keys), corpus.unique, tuple(kept))
        index.add(corpus.df, corpus.text)
        return index

    def _stored(self, name: str, schema: str | T.StructType) -> DataFrame:
        """A table of the index; empty as long as nothing is written there."""
        path = f"{self.path}/{name}"
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def segments(self) -> list[tuple[int, int, int]]:
        """Number, documents and words of each segment in use. One row for each write."""
        rows = self._stored("totals", _TOTALS + ", segment int").collect()
        retired = {s for r in rows for s in r["retires"] or []}
        return sorted((r["segment"], r["docs"], r["words"]) for r in rows if r["segment"] not in retired)

    def _next(self) -> int:
        return 1 + max([r["segment"] for r in self._stored("totals", _TOTALS + ", segment int").collect()], default=-1)

    def _live(self, name: str, segments: Sequence[tuple[int, int, int]], schema: str) -> DataFrame:
        found = self._stored(name, schema + ", segment int")
        return found.filter(F.col("segment").isin([s for s, _, _ in segments]))

    def documents(self) -> DataFrame:
        """``row, keys…, kept…, words`` of the documents in use."""
        segments = self.segments()
        return self._numbered(segments).join(self._removed(segments).select("row"), "row", "left_anti")

    def _numbered(self, segments: Sequence[tuple[int, int, int]]) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/documents")
        return rows.filter(F.col("segment").isin([s for s, _, _ in segments])).drop("segment")

    def _removed(self, segments) -> DataFrame:
        return self._live("removed", segments, "row bigint, words int")

    def add(self, df: DataFrame, text: str) -> int:
        """A segment of its own for these documents; its number."""
        segment = self._next()
        named = [*self.keys, *self.kept]
        rows = df.select(*named, tokens(F.coalesce(text, F.lit(""))).alias("_w"))
        fields = T.StructType([T.StructField("row", T.LongType()), *[T.StructField(c, rows.schema[c].dataType) for c in named], T.StructField("words", T.IntegerType())])
        schema = T.StructType([*fields.fields, *T._parse_datatype_string(_BLOCKS).fields])

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            begin = ((segment << _TASK_BITS) + TaskContext.get().partitionId()) << _ROW_BITS
            for batch in (part for whole in batches if whole.num_rows for part in _steps(whole, "_w", STEP)):
                n = batch.num_rows
                words = batch.column("_w")
                lengths = np.diff(words.offsets.to_numpy())
                yield _record(schema, {"row": pa.array(np.arange(begin, begin + n)), **{c: batch.column(c) for c in named}, "words": pa.array(lengths.astype(np.int32))}, n)
                term, doc, tf, names = _term_counts(words)
                block = doc // BLOCK
                cut = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))[: len(term)])
                if len(cut):
                    ends = np.append(cut, len(term)).astype(np.int32)
                    lists = {"place": doc % BLOCK, "tf": tf, "len": lengths[doc]}
                    columns = {c: pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for c, v in lists.items()}
                    columns |= {
                        "term": names.take(pa.array(term[cut])), "block": pa.array(begin // BLOCK + block[cut]), "n": pa.array(np.diff(ends)),
                        "most_tf": pa.array(np.maximum.reduceat(tf, cut).astype(np.int32)),
                        "least_len": pa.array(np.minimum.reduceat(lengths[doc], cut).astype(np.int32)),
                    }
                    yield _record(schema, columns, len(cut))
                # Blocks end with their step.
                begin += -(-n // BLOCK) * BLOCK

        # Numbers are given once, to documents and words alike.
        scanned = cut_lineage(rows.mapInArrow(scan, schema), "indexed")
        scanned.filter("term IS NULL").select(fields.names).write.mode("overwrite").parquet(f"{self.path}/documents/segment={segment}")
        self._write(scanned.filter("term IS NOT NULL").select(T._parse_datatype_string(_BLOCKS).names), segment)
        self._commit(segment, [])
        return segment

    def _write(self, blocks: DataFrame, segment: int) -> None:
        """The rows of a word next to each other, those of a frequent word in many files."""
        order = ["term", "block"]
        blocks.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{self.path}/blocks/segment={segment}")

    def _commit(self, segment: int, retires: list[int]) -> None:
        documents = self.spark.read.parquet(f"{self.path}/documents/segment={segment}")
        totals = documents.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
        totals = totals.withColumn("retires", F.array(*[F.lit(s) for s in retires]).cast("array<int>"))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals/segment={segment}")

    def remove(self, gone: DataFrame) -> None:
        """Documents whose keys are in ``gone`` are no longer found."""
        names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        self.remove_rows(self.documents().join(gone.select(*names), same, "left_semi"))

    def remove_rows(self, rows: DataFrame) -> None:
        """The same for rows of ``documents``."""
        rows = cut_lineage(rows.select("row", "words"), "removed")
        segment = F.shiftright("row", _TASK_BITS + _ROW_BITS).cast("int")
        block = rows.select(F.expr(f"row div {BLOCK}").alias("block"), F.expr(f"row % {BLOCK}").cast("int").alias("_p"))
        postings = self._live("blocks", self.segments(), _BLOCKS).select("segment", "term", "block", F.explode("place").alias("place"))
        lost = postings.join(block, ["block"]).filter("place = _p").groupBy("segment", "term").agg(F.count(F.lit(1)).alias("n"))
        lost.write.mode("append").partitionBy("segment").parquet(f"{self.path}/less")
        # Rows count as removed from here on; what their words lose was written before.
        rows.withColumn("segment", segment).write.mode("append").partitionBy("segment").parquet(f"{self.path}/removed")

    def compact(self) -> None:
        """One segment of all documents in use."""
        segments, segment = self.segments(), self._next()
        number = number_rows(self.documents(), ["row"], "_n")
        first = segment << (_TASK_BITS + _ROW_BITS)
        number = cut_lineage(number.withColumn("_n", F.lit(first) + F.col("_n") - 1), "renumbered")
        number.drop("row").withColumnRenamed("_n", "row").select("row", *self.keys, *self.kept, "words").write.mode("overwrite").parquet(f"{self.path}/documents/segment={segment}")
        postings = self._live("blocks", segments, _BLOCKS).select(
            "term", "block", F.inline(F.arrays_zip("place", "tf", "len"))
        ).withColumn("row", F.col("block") * BLOCK + F.col("place"))
        moved = postings.join(number.select("row", "_n"), "row").withColumn("block", F.expr(f"_n div {BLOCK}"))
        held = F.sort_array(F.collect_list(F.struct((F.col("_n") % BLOCK).cast("int").alias("place"), "tf", "len")))
        # At most a block of documents in a group.
        grouped = moved.groupBy("term", "block").agg(
            held.alias("h"), F.count(F.lit(1)).cast("int").alias("n"), F.max("tf").alias("most_tf"), F.min("len").alias("least_len")
        )
        self._write(grouped.select("term", "block", "h.place", "h.tf", "h.len", "n", "most_tf", "least_len"), segment)
        self._commit(segment, [s for s, _, _ in segments])

    def rank_keys(self, queries: Sequence[str], *, limit: int = DEFAULT_RESULTS) -> DataFrame:
        """As ``search.rank_keys`` in mode ``basic``."""
        request_terms(queries)
        asked = self.spark.createDataFrame(list(enumerate(queries, 1)), "query_no int, text string")
        return self.rank_table(asked, "query_no", "text", limit=limit)

    def rank_table(self, queries: DataFrame, key: str, text: str, *, limit: int = DEFAULT_RESULTS) -> DataFrame:
        """The best ``limit`` documents of every row of a table of queries: ``key, keys…, score, rank``."""
        return self.ranked(queries, key, text, limit=limit)[0]

    def ranked(
        self, queries: DataFrame, key: str, text: str, *, limit: int = DEFAULT_RESULTS, waves: Sequence[int] = WAVES
    ) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
        """The results, the ``bound`` of each query (``_q``) and block, and for each wave the blocks that were scored."""
        if not 1 <= limit <= MAX_RESULTS:
            raise ValueError(f"limit must be from 1 to {MAX_RESULTS}")
        segments = self.segments()
        removed = self._removed(segments)
        lost = removed.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
        docs = sum(d for _, d, _ in segments) - lost["docs"]
        mean = max(1, sum(w for _, _, w in segments) - lost["words"]) / max(1, docs)
        blocks = self._live("blocks", segments, _BLOCKS)
        asked = cut_lineage(self._asked(queries.select(F.col(key).alias("_q"), F.col(text).alias("_t")), blocks, segments, docs), "asked")
        most = F.col("idf") * _weight(F.col("most_tf"), F.col("least_len"), mean)
        bounds = asked.join(blocks.select("term", "block", "most_tf", "least_len"), "term").groupBy("_q", "block").agg(F.sum(most).alias("bound"))
        by_bound = Window.partitionBy("_q").orderBy(F.desc("bound"), "block")
        bounds = cut_lineage(bounds.withColumn("place", F.row_number().over(by_bound)), "bounds")
        best: DataFrame | None = None
        scored: list[DataFrame] = []
        begin = 0
        for end in [*waves, None]:
            chosen = bounds.filter(F.col("place") > begin)
            if end is not None:
                chosen = chosen.filter(F.col("place") <= end)
            if best is not None:
                # The last result so far, of queries that have as many as asked for.
                least = best.groupBy("_q").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("least")).filter(F.col("c") >= limit)
                chosen = chosen.join(least, "_q", "left").filter(F.col("least").isNull() | (F.col("bound") + SLACK >= F.col("least")))
            chosen = chosen.select("_q", "block")
            scored.append(chosen)
            hits = self._scores(chosen, asked, blocks, removed, mean)
            best = self._best(hits if best is None else hits.unionByName(best.select(*hits.columns)), segments, limit)
            # Read twice by the next wave.
            best = best if end is None else cut_lineage(best, "best")
            begin = end
        order = Window.partitionBy("_q").orderBy(F.desc("score"), *self.keys)
        results = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
        return results.select(F.col("_q").alias(key), *self.keys, "score", "rank"), bounds, scored

    def _asked(self, queries: DataFrame, blocks: DataFrame, segments, docs: int) -> DataFrame:
        """``_q, term, idf`` of the words of the queries."""
        words = queries.select("_q", F.explode(F.array_distinct(tokens(F.col("_t")))).alias("term"))
        terms = words.select("term").distinct()
        found = blocks.select("term", F.col("n").cast("bigint").alias("n")).unionByName(
            self._live("less", segments, "term string, n bigint").select("term", (-F.col("n")).alias("n"))
        )
        df = found.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df")).filter("df > 0")
        idf = F.ln(1 + (F.lit(docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return words.join(df.select("term", idf.alias("idf")), "term")

    def _scores(self, chosen: DataFrame, asked: DataFrame, blocks: DataFrame, removed: DataFrame, mean: float) -> DataFrame:
        """``_q, row, score`` of the documents of chosen blocks."""
        wanted = chosen.join(asked, "_q").join(blocks.select("term", "block", "place", "tf", "len"), ["term", "block"])
        parts = wanted.select("_q", "block", "idf", F.inline(F.arrays_zip("place", "tf", "len"))).select(
            "_q", (F.col("block") * BLOCK + F.col("place")).alias("row"), (F.col("idf") * _weight(F.col("tf"), F.col("len"), mean)).alias("part")
        )
        hits = parts.groupBy("_q", "row").agg(F.round(F.sum("part"), 6).alias("score")).filter("score > 0")
        return hits.join(removed.select("row"), "row", "left_anti").select("_q", "row", "score")

    def _best(self, hits: DataFrame, segments: Sequence[tuple[int, int, int]], limit: int) -> DataFrame:
        """``_q, row, score, keys…`` of the best documents of each query, with all that tie with the last one."""
        place = Window.partitionBy("_q").orderBy(F.desc("score"))
        columns = ["_q", "row", "score", *self.keys]
        known = self._numbered(segments).select("row", *self.keys)
        if self.unique:
            # Ties are cut by their keys at the end.
            top = hits.select("_q", "row", "score").withColumn("_r", F.rank().over(place)).filter(F.col("_r") <= limit)
            return top.join(known, "row").select(*columns)
        named = hits.select("_q", "row", "score").join(known, "row")
        one = named.groupBy("_q", *self.keys).agg(F.max("score").alias("score"), F.min("row").alias("row"))
        return one.withColumn("_r", F.rank().over(place)).filter(F.col("_r") <= limit).select(*columns)


def _record(schema: T.StructType, columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    arrays = [columns[f.name].cast(to_arrow_type(f.dataType)) if f.name in columns else pa.nulls(n, to_arrow_type(f.dataType)) for f in schema.fields]
    return pa.RecordBatch.from_arrays(arrays, schema.names)
