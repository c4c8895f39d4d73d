"""Token ids in byte-aligned variable-length files.

Ids are replaced by their frequency rank in the whole corpus, so that frequent ones take one byte. Every four ranks share a control
byte, two bits each for the number of data bytes (1 to 4); control and data bytes are kept apart. A table of 256
rows, looked up with a whole column of control bytes at once, says where data bytes belong.

A file holds documents in ascending ``doc_id`` (null first, repeated ones by a hash of the text) as chunks of
about ``chunk_ids`` ids, at least one document each: ``doc_id`` and number of ids of each document, control bytes,
data bytes. Texts become ids once; every task counts its ids, and the counts are summed to one ranking of at most the
vocabulary, stored once beside the chunks. The container is Parquet, which every store Spark writes to can hold.

Null texts are empty: such a document has the end id only. Empty tables give no rows, extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablerich.llm.common import query, table
from tablerich.llm.tokens import binaries, default_path, encoder
from tablerich.session import scratch_path

SCHEMA = (
    "part bigint, chunk bigint, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, control binary, data binary"
)
#: The ranking of the corpus, a row for each id that occurs.
RANKS = "rank bigint, id bigint, n bigint"
_CODES = np.array([[(c >> (2 * i)) & 3 for i in range(4)] for c in range(256)], np.uint8)
#: For each control byte, which of the bytes of its four values are stored.
_STORED = np.arange(4) <= _CODES[:, :, None]


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.concatenate([values, np.zeros(-len(values) % 4, values.dtype)]).astype("<u4")
    codes = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4, 4)[_STORED[control]].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values, by a table lookup."""
    stored = _STORED[np.frombuffer(control, np.uint8)]
    out = np.zeros(stored.shape, np.uint8)
    out[stored] = np.frombuffer(data, np.uint8)
    return out.reshape(-1, 4).view("<u4").ravel()[:n]


def ranking(counts: np.ndarray) -> np.ndarray:
    """The ids that occur by frequency, ties by id."""
    return np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]


def pack_chunk(documents: list[np.ndarray], ranked: np.ndarray | None = None) -> tuple[bytes, bytes, bytes]:
    """Rank table, control and data bytes of a chunk; by its own ranks if none are given."""
    ids = np.concatenate(documents)
    if ranked is None:
        ranked = ranking(np.bincount(ids))
    rank = np.zeros(int(ranked.max()) + 1, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
    return ranked.astype("<u4").tobytes(), *encode(rank[ids])


def unpack_chunk(ranked: bytes, control: bytes, data: bytes, counts: np.ndarray) -> list[np.ndarray]:
    """The ids of each document of a chunk."""
    ids = np.frombuffer(ranked, "<u4")[decode(control, data, int(counts.sum()))]
    return np.split(ids, np.cumsum(counts)[:-1])


def _counted(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, place, ids`` of every row, ``ids`` as little-endian 16-bit, and rows with the ``counts`` of the ids of each task."""
    kind = pa.list_(pa.int64())
    names = ["doc_id", "place", "ids", "counts"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            at = 0
            for ids, bounds in coder.encode_steps(batch.column("text"), end_id):
                n = len(bounds) - 1
                counts += np.bincount(ids, minlength=len(counts))
                columns = [batch.column(c).slice(at, n) for c in ("doc_id", "place")]
                yield pa.RecordBatch.from_arrays([*columns, binaries(ids, bounds), pa.nulls(n, kind)], names)
                at += n
        none = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], kind)]
        yield pa.RecordBatch.from_arrays(none, names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("place"), "text")
    return rows.mapInArrow(scan, "doc_id bigint, place bigint, ids binary, counts array<bigint>")


def write_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, chunk_ids: int = 1 << 20) -> None:
    """Write the ids of ``docs`` (``doc_id, text``) below ``path``."""
    tokenizer = tokenizer or default_path()
    staged = scratch_path(docs.sparkSession, "token-ids")
    counted = _counted(docs, tokenizer, end_id)
    counted.write.option("compression", "zstd").parquet(staged)
    rows = docs.sparkSession.read.schema(counted.schema).parquet(staged)
    # One number for each id of the vocabulary.
    per_id = rows.filter("counts IS NOT NULL").select(F.posexplode("counts")).groupBy("pos").agg(F.sum("col").alias("n"))
    counts = np.zeros(1 << 16, np.int64)
    for r in per_id.filter("n > 0").collect():
        counts[r["pos"]] = r["n"]
    ranked = ranking(counts)
    ranks = [(rank, int(i), int(counts[i])) for rank, i in enumerate(ranked)]
    docs.sparkSession.createDataFrame(ranks, RANKS).coalesce(1).write.parquet(f"{path}/ranks")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunk, size = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            _, control, data = pack_chunk(held, ranked)
            row = [[part], [chunk], [size], [doc_ids], [[len(h) for h in held]], [control], [data]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _ARROW.types)], schema=_ARROW)

        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                doc_ids.append(name)
                held.append(np.frombuffer(ids.as_py(), "<u2"))
                size += len(held[-1])
                if size >= chunk_ids:
                    yield flush()
                    chunk, size, doc_ids, held = chunk + 1, 0, [], []
        if held:
            yield flush()

    order = ["doc_id", "place"]
    ranged = rows.filter("ids IS NOT NULL").select("doc_id", "place", "ids").repartitionByRange(*order)
    # Chunks hardly compress further.
    ranged.sortWithinPartitions(*order).mapInArrow(pack, SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/chunks")


_ARROW = pa.schema(
    [("part", pa.int64()), ("chunk", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
     ("counts", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, and its ``ids`` if asked for.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is of the ids as little-endian 32-bit integers.
    """
    files = spark.read.schema(SCHEMA).parquet(f"{path}/chunks")
    # At most the vocabulary.
    stored = spark.read.schema(RANKS).parquet(f"{path}/ranks").orderBy("rank").collect()
    ranked = np.array([r["id"] for r in stored], "<u4").tobytes()
    sizes = files.groupBy("part", "chunk").agg(F.sum("n_ids").alias("n"))
    # One row for each part: a part is a partition of the writing job.
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    within = Window.partitionBy("part").orderBy("chunk")
    chunks = sizes.withColumn("inside", F.sum("n").over(within) - F.col("n")).join(parts, "part").select(
        "part", "chunk", (F.col("before") + F.col("inside")).alias("first")
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                counts = np.array(r["counts"], np.int64)
                documents = unpack_chunk(ranked, r["control"], r["data"], counts)
                columns = {
                    "part": pa.array([r["part"]] * len(counts), pa.int64()),
                    "chunk": pa.array([r["chunk"]] * len(counts), pa.int64()),
                    "doc_id": pa.array(r["doc_ids"], pa.int64()),
                    "start": pa.array(np.cumsum(counts) - counts),
                    "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(d.tobytes()) for d in documents], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([d.astype(np.int32) for d in documents], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    kind = "part bigint, chunk bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    found = files.drop("n_ids").mapInArrow(unpack, kind)
    return found.join(chunks, ["part", "chunk"]).withColumn("start", F.col("first") + F.col("start")).drop("part", "chunk", "first")


@query("op7_token_files")
def op7_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_files(table(spark, sf_dir, "documents"), path)
    return read_files(spark, path)
