"""Suffix-array deduplication by bucket-pointer refinement.

Suffixes first fall into buckets by their leading bytes (``repeats`` deals buckets that several documents share
to tasks and settles all others). Inside a task they are bucketed by 8 bytes, and the buckets are refined by
sorting on the identifiers of the bucket that a suffix has at a later offset: suffixes with equal pairs of
identifiers at ``i`` and ``i + d`` agree in ``2 d`` bytes. Each round reads the identifiers the round before has
written, so the depth doubles until it covers the window. Identifiers are ranks, not hashes: equal ones
mean equal bytes.

A byte is removed if it is covered by a ``window``-byte string that also starts in a document with a smaller
``doc_id``. Null texts are empty, a null ``doc_id`` comes after all others, rows that share a ``doc_id`` do not
remove from each other. Repeated rows get equal results. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tablerich.llm.common import query, table
from tablerich.llm.repeats import Bytes, remove_repeats

WINDOW = 50
GRAM = 24


def _ranks(codes: np.ndarray) -> np.ndarray:
    """Bucket identifiers: equal for equal codes, in their order."""
    order = np.argsort(codes)
    ranked = codes[order]
    out = np.empty(len(codes), np.uint64)
    out[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]), dtype=np.uint64)
    return out


def refine(buffer: bytes, starts: np.ndarray, window: int) -> np.ndarray:
    """Bucket identifiers of the suffixes at ``starts`` by their first ``window`` bytes."""
    raw = buffer + bytes(window + 16 - len(buffer) % 8)
    n = len(buffer) + window
    depth = min(8, window)
    codes = np.empty(len(raw) // 8 * 8 - 8, np.uint64)
    for i in range(8):
        codes[i::8] = np.frombuffer(raw, ">u8", len(codes[i::8]), i)
    codes = codes[:n] >> np.uint64(64 - 8 * depth)
    ids = _ranks(np.concatenate([codes, np.zeros(max(0, n - len(codes)), np.uint64)]))
    while 2 * depth <= window:
        ids = _ranks((ids << np.uint64(32)) | np.concatenate([ids[depth:], np.zeros(depth, np.uint64)]))
        depth *= 2
    if depth == window:
        return ids[starts].astype(np.int64)
    return _ranks((ids[starts] << np.uint64(32)) | ids[starts + window - depth]).astype(np.int64)


def classify(texts: list[bytes], counts: np.ndarray, window: int) -> np.ndarray:
    """The class of every window of the texts."""
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return refine(b"".join(texts), np.repeat(begin, counts) + inside, window)


def suffix_array_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, as bytes)."""
    units = Bytes(window, max(8, min(GRAM, window // 2)))
    return remove_repeats(docs, units, classify, with_text).withColumnRenamed("n_units", "n_bytes")


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (SELECT doc_id, c, substr(x, 2 * c + 1, 1098) AS y FROM d, unnest(range(0, length(x) // 2, 500)) AS t(c)),
windows AS (
  SELECT doc_id, c + j AS i, substr(y, 2 * j - 1, 100) AS k FROM pieces, unnest(range(1, least(501, length(y) // 2 - 48))) AS t(j)
), firsts AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
starts AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE m < doc_id),
edges AS (
  SELECT doc_id, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS first FROM starts
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (
    SELECT doc_id, i, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM edges) GROUP BY doc_id, n
), cut AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS kept_from, b,
    row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS last FROM spans
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * kept_from - 1, 2 * (a - kept_from)), '' ORDER BY a)
      || max(CASE WHEN last THEN substr(x, 2 * b - 1) END) AS k,
    sum(b - a) AS removed, count(*) AS n FROM cut JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op1_suffix_array_dedup", SQL)
def op1_suffix_array_dedup(spark, sf_dir):
    return suffix_array_dedup(table(spark, sf_dir, "documents"))
