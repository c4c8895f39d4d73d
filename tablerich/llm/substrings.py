"""Substring deduplication by prefix-partitioned suffix trees.

Suffixes are split into groups by prefixes of variable length: ``repeats`` deals them by their first words, and a
task splits what it gets by ever longer prefixes until a group fits ``group_size``. A group is one subtree: its
suffixes are sorted, neighbours' common prefixes give its internal nodes, and nodes as deep as the window are the
repeats. All leaves below such a node hold the same window, so those that are not of the node's first document
repeat it.

A word is removed if it is covered by ``window`` consecutive words that also start in a document with a smaller
``doc_id``. Words lie between white space of ``[\\x20\\x09-\\x0D]`` and are compared unchanged. Null texts have no
words, a null ``doc_id`` comes after all others, rows that share a ``doc_id`` do not remove from each other.
Repeated rows get equal results. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tablerich.llm.common import query, table
from tablerich.llm.repeats import Words, remove_repeats

WINDOW = 13
GRAM = 5
GROUP = 1 << 16


def prefix_groups(words: np.ndarray, starts: np.ndarray, window: int, group_size: int) -> Iterator[np.ndarray]:
    """Indices of ``starts`` in groups that share a prefix, as short as keeps each below ``group_size``."""
    waiting = [(np.arange(len(starts)), 0)]
    while waiting:
        group, depth = waiting.pop()
        if len(group) <= group_size or depth == window:
            yield group
            continue
        first = words[starts[group] + depth]
        order = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[order])) + 1
        small: list[np.ndarray] = []
        for part in np.split(group[order], cuts):
            if len(part) > group_size:
                waiting.append((part, depth + 1))
            else:
                small.append(part)
        # Prefixes next to each other share a group as long as it has room.
        held, size = [], 0
        for part in small:
            if size + len(part) > group_size and held:
                yield np.concatenate(held)
                held, size = [], 0
            held.append(part)
            size += len(part)
        if held:
            yield np.concatenate(held)


def subtree(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of a subtree in order, and the common prefix of each with the one before (0 for the first)."""
    suffixes = words[starts[:, None] + np.arange(window)]
    order = np.lexsort(suffixes.T[::-1])
    ordered = suffixes[order]
    same = np.cumprod(ordered[1:] == ordered[:-1], axis=1).sum(axis=1)
    return order, np.concatenate([[0], same])


def classify(texts: list[bytes], counts: np.ndarray, window: int, group_size: int = GROUP) -> np.ndarray:
    """The class of every window of the texts: the deep node it is below, or one of its own."""
    seen: dict[bytes, int] = {}
    split = [t.split(b" ") for t in texts]
    sizes = np.array([len(s) for s in split])
    words = np.fromiter((seen.setdefault(w, len(seen)) for s in split for w in s), np.int32, int(sizes.sum()))
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(begin, counts) + inside
    classes = np.empty(len(starts), np.int64)
    known = 0
    for group in prefix_groups(words, starts, window, group_size):
        order, common = subtree(words, starts[group], window)
        node = np.cumsum(common < window) - 1
        classes[group[order]] = known + node
        known += int(node[-1]) + 1
    return classes


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_removed, n_spans, kept_sha256`` (and ``kept``, as bytes)."""
    found = remove_repeats(docs, Words(window, min(GRAM, window)), classify, with_text)
    return found.withColumnRenamed("n_units", "n_words")


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (
  SELECT doc_id, list(DISTINCT i + j) AS p FROM windows JOIN firsts USING (k), range(13) AS r(j) WHERE m < doc_id GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN p IS NULL THEN w ELSE [w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(p, i)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


@query("op2_substring_dedup", SQL)
def op2_substring_dedup(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents")).drop("n_spans")
