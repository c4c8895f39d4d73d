"""Exact deduplication by a keyed stream state.

Each document sends its digest, length and identifier through a streaming aggregation whose state, kept on
disk in RocksDB without a watermark and so without expiry, holds for each digest the document that stays:
its identifier, which also locates its text, and the number of rows seen. Rows that hit a digest held by
another document are then compared with that document's text byte by byte.

Texts are equal when they are after deleting every white space of ``[\\x20\\x09-\\x0D]``; null is empty. Of
equal texts the row with the most code points stays, then the smallest ``doc_id``; of repeated rows of that
``doc_id`` the one with the smallest text. A null ``doc_id`` stays only if no other row of its group has as many
code points. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablerich.llm.common import query, table, text_of, without_spaces
from tablerich.session import cut_lineage, scratch_path, separate_session

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Files of a state partition are as long as what they hold.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _sha256(normalised: Column) -> Column:
    return F.sha2(normalised, 256)


def keyed_log(docs: DataFrame, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """What the state needs of each row: ``doc_id, digest, n_points``."""
    return docs.select(
        "doc_id", digest(without_spaces(text_of())).alias("digest"), F.length(text_of()).alias("n_points")
    )


def holders(log: DataFrame) -> DataFrame:
    """Streaming or batch: for each digest the holder ``(n_points, order, doc_id)`` and the rows seen.

    Rows of a digest are reduced in each task before they are shuffled to its state.
    """
    # The largest struct wins: most code points, then the smallest identifier.
    best = F.struct("n_points", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("order"), "doc_id")
    return log.groupBy("digest").agg(F.max(best).alias("holder"), F.count(F.lit(1)).alias("seen"))


def run_state(spark: SparkSession, log_path: str, schema: str, checkpoint: str, out: str) -> None:
    """Pass what is new in the folder ``log_path`` through the state; changed holders go to ``out/batch=N``.

    The checkpoint holds the state and the files that were read, so a later call goes on from there, and a
    batch that is run again replaces its own output.
    """
    stream = holders(separate_session(spark, STATE).readStream.schema(schema).parquet(log_path))
    (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}"))
        .start()
        .awaitTermination()
    )


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, n_points, digest``.

    ``kept`` holds for every row of the ``doc_id`` that stays; see ``kept_documents`` for its single row.
    """
    spark = docs.sparkSession
    log_path, out, checkpoint = (scratch_path(spark, n) for n in ("digests", "holders", "state"))
    log = keyed_log(docs, digest)
    log.write.parquet(log_path)
    held_type = "digest string, holder struct<n_points: int, known: boolean, order: bigint, doc_id: bigint>, seen bigint"
    # There are holders to read even if there is no row.
    spark.createDataFrame([], held_type).write.parquet(f"{out}/batch=none")
    run_state(spark, log_path, "doc_id bigint, digest string, n_points int", checkpoint, out)
    log = spark.read.parquet(log_path)
    # A later batch repeats a digest it has changed; holders only get better and counts only grow.
    held = spark.read.schema(held_type).parquet(f"{out}/*")
    held = cut_lineage(
        held.groupBy("digest").agg(F.max("holder").alias("holder"), F.max("seen").alias("group_size"))
        .select("digest", "holder.doc_id", "group_size")
        .withColumnRenamed("doc_id", "keep_id"),
        "held",
    )
    # Written, so that what follows is not dealt by the digest alone: one may have a third of all rows.
    marked = cut_lineage(log.join(held, "digest"), "marked")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    columns = ["doc_id", "keep_id", "group_size", kept, "n_points", "digest"]
    wrong = cut_lineage(_collisions(docs, marked, digest), "collisions")
    if wrong.isEmpty():
        return marked.select(*columns)
    # A digest that two texts share is no key: its rows are grouped by the text itself.
    text = docs.select("doc_id", F.length(text_of()).alias("n_points"), without_spaces(text_of()).alias("bytes"))
    exact = text.withColumn("digest", digest(F.col("bytes"))).join(wrong, "digest")
    groups = holders(exact.select("doc_id", F.struct("digest", "bytes").alias("digest"), "n_points")).select(
        "digest.digest", "digest.bytes", F.col("holder.doc_id").alias("keep_id"), F.col("seen").alias("group_size")
    )
    regrouped = exact.join(cut_lineage(groups, "regrouped"), ["digest", "bytes"])
    return marked.join(wrong, "digest", "left_anti").select(*columns).unionByName(regrouped.select(*columns))


def _collisions(docs: DataFrame, marked: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests under which a row's bytes differ from its holder's."""
    held = marked.filter("group_size > 1")
    keepers = held.select("keep_id", F.col("digest").alias("of")).distinct()
    hits = held.select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("of")).distinct()
    text = docs.select("doc_id", without_spaces(text_of()).alias("bytes")).withColumn("digest", digest(F.col("bytes")))
    # Rows without a doc_id are one name: all of them under a digest are compared.
    mine = text.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("of")), "left_semi")
    mine = cut_lineage(mine, "hits")
    theirs = mine.join(keepers, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("of")), "left_semi")
    theirs = cut_lineage(theirs.select("digest", F.col("bytes").alias("held")), "held_bytes")
    # Written before it is reduced, so that a digest with very many hits can be split.
    return cut_lineage(mine.join(theirs, "digest").filter("bytes != held").select("digest"), "differing").distinct()


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns; one of repeated rows of the ``doc_id`` that stays."""
    keys = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("keep"), F.col("digest").alias("held")).distinct()
    keys = cut_lineage(keys, "kept")
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_of().alias("words"),
        _sha256(without_spaces(text_of())).alias("digest"),
    )
    same = own.join(keys, F.col("id").eqNullSafe(F.col("keep")) & (F.col("digest") == F.col("held")), "left_semi")
    first = Window.partitionBy("id", "digest").orderBy(F.length("words").desc(), "words")
    return same.withColumn("n", F.row_number().over(first)).filter("n = 1").select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY length(text) DESC, doc_id)
"""


@query("op4_exact_dedup", SQL)
def op4_exact_dedup(spark, sf_dir):
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
