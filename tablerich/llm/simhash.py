"""SimHash near-duplicates by balls that meet in the middle.

A fingerprint has 64 bits: of the XXH64 hashes of a document's word shingles, the bits set in over half of
them. Fingerprints link at ``radius`` 3 or fewer differing bits, documents without words (fingerprint zero)
like any others.

Two linked fingerprints meet: flipping at most one bit of one and at most two of the other gives a common
variant. At distance 3 one of them has an even number of set bits and the other an odd one, so only even ones
have to flip two. Every fingerprint emits its variants, and the rows are shuffled on them. All that reach
a variant by at most one flip are within 2 of each other, and any that reach it by two flips is within 3 of
those; so each is tied to the smallest of the former, checked, and no pairs within a group are built.
A group holds at most 1 + 64 + 2016 distinct fingerprints, whatever the data.

Balls are large, so a first pass leaves out fingerprints that have no partner: two linked ones differ in at most
three of six blocks of bits, so a fingerprint stays if it agrees with another one on some three of them (20 keys of
about 32 bits). The pass never drops one that has a link. Fingerprints are dealt out by their number before either
step, as a few megabytes of them become very many rows.

Null texts are empty. Rows with the same ``doc_id`` are one document in the graph and each has its own
fingerprint; a null ``doc_id`` counts as larger than any. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tablerich.llm.common import query, table
from tablerich.llm.components import connected_components
from tablerich.session import cut_lineage

RADIUS = 3
SEED = 42
#: Hashes whose bits are counted at once.
_STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _STEP):
        bits = np.unpackbits(hashes[i : i + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(hashed, f"doc_id {kind}, fp bigint")


#: Fingerprints of two that link agree on three of these six blocks of bits at least.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Rows a task makes of the fingerprints it is dealt.
TASK_ROWS = 1 << 20


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(masks: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{_signed(m)}L' for m in masks)})")


def _dealt(fps: DataFrame, rows: int, each: int) -> DataFrame:
    """Fingerprints over as many tasks as the ``each`` rows they will make ask for: by bytes, Spark would take one."""
    spark = fps.sparkSession
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return fps.repartition(max(least, -(-rows * each // TASK_ROWS)), "fp")


def _partnered(distinct: DataFrame) -> DataFrame:
    """Fingerprints that agree with another one on three blocks."""
    ends = np.cumsum(BLOCKS).tolist()
    blocks = [((1 << n) - 1) << (end - n) for end, n in zip(ends, BLOCKS)]
    masks = [a | b | c for a, b, c in itertools.combinations(blocks, 3)]
    dealt = _dealt(distinct, distinct.count(), len(masks))
    keys = dealt.select("fp", F.posexplode(_masks(masks)).alias("mask", "bits"))
    keys = keys.select("fp", "mask", F.col("fp").bitwiseAND(F.col("bits")).alias("key"))
    met = keys.groupBy("mask", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b")
    met = cut_lineage(met.select(F.col("mask").alias("m"), F.col("key").alias("k")), "blocks")
    return keys.join(met, (F.col("mask") == F.col("m")) & (F.col("key") == F.col("k")), "left_semi").select("fp").distinct()


def _variants(fps: DataFrame, rows: int) -> DataFrame:
    """``variant, fp, flips`` for the ball of every fingerprint."""
    ones = [1 << b for b in range(64)]
    pairs = [a | b for a, b in itertools.combinations(ones, 2)]
    dealt = _dealt(fps, rows, 1 + len(ones) + len(pairs) // 2)
    near = dealt.select("fp", F.explode(_masks([0, *ones])).alias("mask")).withColumn("flips", F.when(F.col("mask") == 0, 0).otherwise(1))
    even = dealt.filter(F.bit_count("fp") % 2 == 0)
    far = even.select("fp", F.explode(_masks(pairs)).alias("mask")).withColumn("flips", F.lit(2))
    return near.unionByName(far).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp", "flips")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def linked(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of fingerprints that connect all within ``RADIUS`` of each other."""
    fps = cut_lineage(_partnered(distinct), "partnered")
    ball = _variants(fps, fps.count())
    group = Window.partitionBy("variant")
    centre = F.min(F.when(F.col("flips") < 2, F.col("fp"))).over(group)
    met = ball.withColumn("centre", centre).filter("centre IS NOT NULL AND fp != centre")
    return met.select(F.col("centre").alias("a"), F.col("fp").alias("b")).distinct().filter(distance(F.col("a"), F.col("b")) <= RADIUS)


def components(docs: DataFrame, shingle: int = 3) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp`` of every row, and ``fp, component, component_id`` of every fingerprint; ``component`` is the least of its fingerprints."""
    rows = cut_lineage(fingerprints(docs, shingle), "fingerprints")
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    # Fingerprints are the nodes: one that only rows without a doc_id have still links others.
    links = linked(nodes.select("fp"))
    # A repeated doc_id ties its fingerprints.
    repeated = rows.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low != high")
    own = rows.join(cut_lineage(repeated.select("doc_id", "low"), "repeated"), "doc_id")
    found = connected_components(links.unionByName(own.select(F.col("fp").alias("a"), F.col("low").alias("b"))))
    found = found.select(F.col("node").alias("fp"), "component")
    member = nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    member = cut_lineage(member, "members")
    names = cut_lineage(member.groupBy("component").agg(F.min("least").alias("component_id")), "names")
    return rows, cut_lineage(member.join(names, "component").select("fp", "component", "component_id"), "reach")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, fp, component_id`` (the smallest ``doc_id`` reachable, null if none is)."""
    rows, reach = components(docs, shingle)
    return rows.join(reach, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One document of each component stays, with all its columns.

    It is the one that names the component; of its rows the one of the smallest text. Of a component that only rows
    without a ``doc_id`` are in, the row of the smallest fingerprint and text stays.
    """
    rows, reach = components(docs, shingle)
    kept = rows.join(reach, "fp").filter("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    kept = cut_lineage(kept, "representatives")
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.col("text").alias("words")
    )
    first = F.row_number().over(Window.partitionBy("id").orderBy("words"))
    named = whole.join(kept, F.col("id") == F.col("kept"), "left_semi").withColumn("n", first).filter("n = 1")
    return named.select("row.*").unionByName(_unnamed(whole.filter("id IS NULL").select("row", "words"), reach, shingle).select("row.*"))


def _unnamed(rows: DataFrame, reach: DataFrame, shingle: int) -> DataFrame:
    """One row of each component without a name; ``rows`` are ``row, words`` of rows without ``doc_id``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column("words")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "mark"])

    marked = rows.mapInArrow(hashed, T.StructType([*rows.schema.fields, T.StructField("mark", T.LongType())]))
    alone = reach.filter("component_id IS NULL AND fp = component").select(F.col("fp").alias("kept"))
    first = F.row_number().over(Window.partitionBy("mark").orderBy("words"))
    return marked.join(alone, F.col("mark") == F.col("kept"), "left_semi").withColumn("n", first).filter("n = 1")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
