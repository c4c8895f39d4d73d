"""Collocations by a weighted de Bruijn graph of words.

Texts are cut into pieces and words. Nodes of the graph are four words, edges five: an edge joins the nodes of its
first and last four words and weighs what it occurs. ``edges`` adds them up; the up to four words at the end of a
piece, which no edge begins with, are kept beside them as corrections. A phrase of four words then occurs as often
as its node is left by edges or ends a piece, one of three words as often as the phrases of four that begin with it
or end a piece, and so on: every shorter count is a sum over the next longer ones (``phrase_counts``).

Only phrases of ``least`` occurrences or more are looked for, which two steps use without changing any count of them:

- A first pass counts pairs of neighbours in a table of buckets of fixed size, whatever the size of the corpus. A pair
  whose whole bucket has fewer than ``least`` is in no such phrase, so pieces are cut there. Buckets only choose where
  to cut; phrases are counted as texts, and every word is counted.
- Edges lighter than ``least`` become corrections of the node they leave. Of the rest, paths whose inner nodes have
  one edge in and one of the same weight out, and no correction, are compacted to one row (``compact``): pointers to
  the predecessor are doubled until they reach the head of a path. Inner nodes weigh what their path does.

A path lies in every piece that touches its inside, so it is no longer than a piece. Counts are added up in every task
before each shuffle, so a phrase in a third of all rows is a row per task.

Null texts are empty, a null ``lang`` is ``und``. Rows count one by one, repeated ones too; identifiers and other
columns are ignored. Empty tables give no rows. Texts longer than a step are cut between pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.llm.common import query, table, text_of
from tablerich.session import cut_lineage

#: Words of an edge, the longest phrase.
LONGEST = 5
#: Occurrences of a phrase.
LEAST = 100
MOST = 2000
#: Buckets for pairs of neighbours: 4 MB of bits.
BUCKETS = 1 << 25
#: Buckets in a row of counts.
BLOCK = 1 << 12
#: Rows of phrases that a task adds up before it sends them.
HELD = 1 << 19
#: Bytes of text that are taken apart at once; a piece is never cut.
STEP = 1 << 20

_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: in a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _steps(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[tuple[bytes, np.ndarray, list[str]]]:
    """Texts of about ``step`` bytes together, each ended by a line feed: the bytes, where texts begin, their languages."""
    parts, size, langs = [], 0, []

    def flush():
        begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]]).astype(np.int64)
        return b"\n".join(parts) + b"\n", begins, list(langs)

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang")):
            data, lang = text.as_buffer(), lang.as_py()
            data = data.to_pybytes() if data is not None else b""
            at = 0
            while at < len(data):
                end = len(data)
                if end - at > step:
                    found = _BREAK.search(data, at + step)
                    end = found.end() if found else end
                parts.append(data[at:end])
                langs.append(lang)
                size += end - at + 1
                at = end
                if size >= step:
                    yield flush()
                    parts, size, langs = [], 0, []
    if parts:
        yield flush()


class _Words:
    """The words of one step: where they are, which follow one another in a piece, and their buckets."""

    _powers = _inverse = np.ones(1, np.uint64)

    def __init__(self, data: bytes, begins: np.ndarray, langs: list[str], names: dict[str, int]):
        self.bytes = _LOWER[np.frombuffer(data, np.uint8)]
        kind = _KIND[self.bytes]
        inside = np.concatenate([[False], kind == 0, [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = change[::2], change[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)
        code = np.array([names.setdefault(x, len(names)) for x in langs], np.int64)
        self.lang = code[np.searchsorted(begins, self.start, "right") - 1]
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)

    def buckets(self, seeds: np.ndarray, n: int) -> np.ndarray:
        """Of every word with the next one of its piece; only means something where ``joined``."""
        _Words._grow(len(self.bytes))
        terms = self.bytes.astype(np.uint64) * _Words._powers[: len(self.bytes)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        # Divided by the power at its begin, a word's sum does not depend on its place.
        word = (sums[self.end] - sums[self.start]) * _Words._inverse[self.start]
        word = _mixed(word + seeds[self.lang] + (self.end - self.start).astype(np.uint64))
        return (_mixed(word * np.uint64(3) + _mixed(np.roll(word, -1))) % np.uint64(n)).astype(np.int64)

    @classmethod
    def _grow(cls, size: int) -> None:
        if size > len(cls._powers):
            for name, base in (("_powers", _BASE), ("_inverse", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size + STEP // 4, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers, dtype=np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _seeds(names: dict[str, int]) -> np.ndarray:
    """A number for each language, by its name."""
    return np.array([int.from_bytes(name.encode()[:64].ljust(8, b"\0"), "little") * _BASE % (1 << 64) for name in names], np.uint64)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def busy_buckets(docs: DataFrame, least: int = LEAST, buckets: int = BUCKETS, step: int = STEP) -> np.ndarray:
    """One bit for each bucket: whether its pairs occur ``least`` times or more together."""
    kind = np.uint8 if least <= 255 else np.uint32
    top = np.iinfo(kind).max

    def add(counts: np.ndarray, found: np.ndarray) -> None:
        # Counts stop at their greatest value, which is no less than what is asked for.
        at, n = np.unique(found, return_counts=True)
        counts[at] = np.minimum(counts[at].astype(np.int64) + n, top)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(buckets, kind), {}
        for data, begins, langs in _steps(batches, step):
            words = _Words(data, begins, langs, names)
            add(counts, words.buckets(_seeds(names), buckets)[words.joined])
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        for i in range(0, len(used), 512):
            some = used[i : i + 512]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([blocks[b].tobytes() for b in some], pa.binary())], ["block", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block."""
        last, sums = None, np.zeros(BLOCK, np.int64)

        def done():
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], ["block", "bits"])

        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != last:
                    if last is not None and (sums >= least).any():
                        yield done()
                    last, sums = block, np.zeros(BLOCK, np.int64)
                sums += np.frombuffer(counts.as_buffer(), kind)
        if last is not None and (sums >= least).any():
            yield done()

    counted = _read(docs).mapInArrow(count, "block bigint, counts binary")
    found = counted.repartition("block").sortWithinPartitions("block").mapInArrow(total, "block bigint, bits binary")
    bits = np.zeros(buckets // 8, np.uint8)
    # A bit for each bucket, whatever the corpus.
    for row in found.toLocalIterator():
        bits[row.block * BLOCK // 8 : (row.block + 1) * BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def _numbered(words: _Words) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the words, from 1 on, and the texts by number."""
    size = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = words.bytes[np.repeat(words.start - offsets[:-1], size) + np.arange(offsets[-1])]
    texts = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    coded = texts.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, pa.concat_arrays([pa.array([""]), coded.dictionary])


def _step_grams(words: _Words, bits: np.ndarray, names: dict[str, int], buckets: int) -> Iterator[tuple[np.ndarray, pa.Array, int, np.ndarray]]:
    """From every word on, the next ``LONGEST`` words or what is left of its run: languages, texts, words of a text, counts."""
    if not len(words.start):
        return
    pair = words.buckets(_seeds(names), buckets)
    link = words.joined.copy()
    at = pair[link]
    link[link] = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    number, texts = _numbered(words)
    lang, n, v = words.lang, len(number), len(texts)
    columns, on = [number], np.ones(n, bool)
    for k in range(1, LONGEST):
        on = on & np.append(link[k - 1 :], np.zeros(k - 1, bool))[:n]
        columns.append(np.where(on, np.append(number[k:], np.zeros(k, np.int64))[:n], 0))
    alone = columns[1] == 0
    key, counts = np.unique(lang[alone] * v + number[alone], return_counts=True)
    yield key // v, texts.take(pa.array(key % v)), 1, counts
    columns, lang = [c[~alone] for c in columns], lang[~alone]
    if not len(lang):
        return
    key = lang
    for c in columns:
        key = pd.factorize(key * v + c)[0]
    counts = np.bincount(key)
    first = np.zeros(len(counts), np.int64)
    first[key[::-1]] = np.arange(len(key))[::-1]
    columns, lang = [c[first] for c in columns], lang[first]
    size = np.sum([c > 0 for c in columns], axis=0)
    for k in range(2, LONGEST + 1):
        rows = np.flatnonzero(size == k)
        if len(rows):
            yield lang[rows], pc.binary_join_element_wise(*[texts.take(pa.array(c[rows])) for c in columns[:k]], " "), k, counts[rows]


def _added(parts: list[pa.Table]) -> pa.Table:
    """Equal phrases as one row."""
    summed = pa.concat_tables(parts).group_by(["lang", "k", "gram"], use_threads=False).aggregate([("c", "sum")])
    return summed.rename_columns({"c_sum": "c"}).select(["lang", "k", "gram", "c"])


def edges(docs: DataFrame, least: int = LEAST, buckets: int = BUCKETS, step: int = STEP) -> DataFrame:
    """``lang, k, gram, c``: edges (``k`` = 5), the ends of pieces (1 to 4), and the number of words of a language (0)."""
    bits = docs.sparkSession.sparkContext.broadcast(busy_buckets(docs, least, buckets, step))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}

        def part(lang, gram, k, c):
            named = pa.array(list(names)).take(pa.array(lang))
            return pa.Table.from_arrays([named, pa.array(np.full(len(c), k, np.int32)), gram, pa.array(c.astype(np.int64))], ["lang", "k", "gram", "c"])

        held: list[pa.Table] = []
        for data, begins, langs in _steps(batches, step):
            words = _Words(data, begins, langs, names)
            if len(words.start):
                lang, c = np.unique(words.lang, return_counts=True)
                held.append(part(lang, pa.array([""] * len(lang)), 0, c))
                held += [part(*found) for found in _step_grams(words, bits.value, names, buckets)]
            if sum(t.num_rows for t in held) >= HELD:
                summed = _added(held)
                held = [summed]
                if summed.num_rows > HELD // 2:
                    yield from summed.to_batches(1 << 16)
                    held = []
        if held:
            yield from _added(held).to_batches(1 << 16)

    found = _read(docs).mapInArrow(grams, "lang string, k int, gram string, c bigint")
    return found.groupBy("lang", "k", "gram").agg(F.sum("c").alias("c"))


def _first(gram: Column, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def _last(gram: Column, k: int) -> Column:
    return F.substring_index(gram, " ", -k)


def compact(heavy: DataFrame, ends: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Paths ``lang, words, c`` of the edges ``lang, gram, c``; ``ends`` are the corrections ``lang, gram, c`` of nodes."""
    node = LONGEST - 1
    out = heavy.select("lang", _first(F.col("gram"), node).alias("node"), F.lit(1).alias("o"), F.col("c").alias("leaving"), F.lit(0).alias("i"),
                       F.lit(0).cast("bigint").alias("coming"), F.lit(None).cast("string").alias("before"))
    into = heavy.select("lang", _last(F.col("gram"), node).alias("node"), F.lit(0).alias("o"), F.lit(0).cast("bigint").alias("leaving"), F.lit(1).alias("i"),
                        F.col("c").alias("coming"), F.col("gram").alias("before"))
    sums = out.unionByName(into).groupBy("lang", "node").agg(
        F.sum("o").alias("o"), F.sum("i").alias("i"), F.sum("leaving").alias("leaving"), F.sum("coming").alias("coming"), F.min("before").alias("before")
    )
    inner = sums.filter("o = 1 AND i = 1 AND leaving = coming").join(
        ends.select("lang", F.col("gram").alias("node")), ["lang", "node"], "left_anti"
    )
    inner = cut_lineage(inner.select(F.col("lang").alias("l"), "node", "before"), "inner")
    same = (F.col("lang") == F.col("l")) & (_first(F.col("gram"), node) == F.col("node"))
    state = heavy.join(inner, same, "left").select(
        "lang", "gram", "c", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("bigint").alias("place")
    )
    state = cut_lineage(state, "pointers")
    for _ in range(most_rounds):
        ahead = state.select(F.col("lang").alias("l"), F.col("gram").alias("g"), F.col("head").alias("h"), F.col("place").alias("p")).filter("p > 0")
        if not state.join(ahead, (F.col("lang") == F.col("l")) & (F.col("head") == F.col("g")), "left_semi").limit(1).count():
            break
        moved = state.join(ahead, (F.col("lang") == F.col("l")) & (F.col("head") == F.col("g")), "left")
        state = cut_lineage(
            moved.select("lang", "gram", "c", F.coalesce("h", "head").alias("head"), (F.col("place") + F.coalesce("p", F.lit(0))).alias("place")), "pointers"
        )
    else:
        raise RuntimeError("paths do not settle")
    step = F.struct("place", _last(F.col("gram"), 1).alias("word"))
    path = state.groupBy("lang", "head").agg(F.array_sort(F.collect_list(step)).alias("steps"), F.min("c").alias("c"))
    begin = F.split(_first(F.col("head"), node), " ")
    return path.select("lang", F.concat(begin, F.col("steps.word")).alias("words"), "c")


def _windows(words: Column, k: int, begin: Column, n: Column) -> Column:
    """``n`` phrases of ``k`` words, from the one that starts at ``begin`` (from 1) on."""
    starts = F.when(n > 0, F.sequence(begin, begin + n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))


def phrase_counts(grams: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, k, gram, f`` of all phrases of 1 to ``LONGEST`` words that occur ``least`` times or more.

    ``grams`` are the ``edges``, best written: they are read several times.
    """
    node = LONGEST - 1
    heavy = grams.filter((F.col("k") == LONGEST) & (F.col("c") >= least)).select("lang", "gram", "c")
    light = grams.filter((F.col("k") == LONGEST) & (F.col("c") < least)).select("lang", _first(F.col("gram"), node).alias("gram"), "c")
    ends = grams.filter(F.col("k") == node).select("lang", "gram", "c").unionByName(light)
    ends = cut_lineage(ends.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "ends")
    paths = cut_lineage(compact(heavy, ends), "paths")
    n = F.size("words")
    longest = paths.select("lang", F.explode(_windows(F.col("words"), LONGEST, F.lit(1), n - node)).alias("gram"), F.col("c").alias("f"))
    # Nodes inside a path weigh what it does; those at its begin get what leaves them, by any path, and what ends there.
    inside = paths.select("lang", F.explode(_windows(F.col("words"), node, F.lit(2), n - node - 1)).alias("gram"), F.col("c").alias("f"))
    begin = paths.select("lang", F.array_join(F.slice("words", 1, node), " ").alias("gram"), "c")
    flow = begin.unionByName(ends).groupBy("lang", "gram").agg(F.sum("c").alias("f"))
    level = cut_lineage(inside.unionByName(flow), f"phrases{node}")
    kept = [longest.select("lang", F.lit(LONGEST).alias("k"), "gram", "f"), level.select("lang", F.lit(node).alias("k"), "gram", "f").filter(F.col("f") >= least)]
    for k in range(node - 1, 0, -1):
        ended = grams.filter(F.col("k") == k).select("lang", "gram", F.col("c").alias("f"))
        flow = level.select("lang", _first(F.col("gram"), k).alias("gram"), "f").unionByName(ended)
        level = cut_lineage(flow.groupBy("lang", "gram").agg(F.sum("f").alias("f")), f"phrases{k}")
        kept.append(level.select("lang", F.lit(k).alias("k"), "gram", "f").filter(F.col("f") >= least))
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    return found


def score(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    """``floor(1000 a n / (l r))`` in whole numbers of up to 38 digits."""
    wide = "CAST({} AS DECIMAL(38, 0))".format
    return F.expr(f"({wide(a)} * {wide(n)} * 1000) div ({wide(l)} * {wide(r)})")


def scored(counts: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of all phrases of two words or more; ``words`` has ``lang, n``."""
    part = lambda j: F.call_function("substring_index", F.col("gram"), F.lit(" "), j)
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("k") - 1),
        lambda j: F.struct(j.alias("j"), part(j).alias("first"), part(j - F.col("k")).alias("rest")),
    )
    cut = counts.filter("k > 1").select("lang", F.col("gram").alias("phrase"), F.col("f").alias("a"), F.inline(cuts))
    left = counts.select(F.col("lang").alias("ll"), F.col("gram").alias("lg"), F.col("f").alias("l"))
    right = counts.select(F.col("lang").alias("rl"), F.col("gram").alias("rg"), F.col("f").alias("r"))
    both = cut.join(left, (F.col("lang") == F.col("ll")) & (F.col("first") == F.col("lg")))
    both = both.join(right, (F.col("lang") == F.col("rl")) & (F.col("rest") == F.col("rg")))
    both = both.join(words.select(F.col("lang").alias("nl"), "n"), F.col("lang") == F.col("nl"))
    best = F.min(F.struct(score("a", "n", "l", "r").alias("score"), "j", "l", "r", "n")).alias("best")
    return both.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")


def covered(counts: DataFrame) -> DataFrame:
    """``lang, gram, longer``: the most occurrences of a phrase one word longer that holds this one.

    A longer phrase with as many occurrences has one of the length between with as many, so this is all the rule needs.
    """
    part = lambda j: F.call_function("substring_index", F.col("gram"), F.lit(" "), j)
    parts = F.array(part(F.col("k") - 1), part(1 - F.col("k")))
    within = counts.filter("k > 2").select("lang", F.explode(parts).alias("gram"), "f")
    return within.groupBy("lang", "gram").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, least: int = LEAST, most: int = MOST, buckets: int = BUCKETS, step: int = STEP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``most`` best phrases of every language.

    ``buckets`` (a multiple of ``BLOCK``) and ``step`` choose how much memory a task takes, not what is found.
    """
    grams = cut_lineage(edges(docs, least, buckets, step), "grams")
    counts = cut_lineage(phrase_counts(grams, least), "counts")
    words = grams.filter("k = 0").select("lang", F.col("c").alias("n"))
    longer = covered(counts).select(F.col("lang").alias("cl"), "gram", "longer")
    free = scored(counts, words).join(longer, (F.col("lang") == F.col("cl")) & (F.col("phrase") == F.col("gram")), "left")
    free = free.filter("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT row_number() OVER () AS i, lang, piece FROM (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents)),
w AS (SELECT i, lang, unnest(ws) AS w, unnest(range(len(ws))) AS pos
  FROM (SELECT i, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p)),
g AS (SELECT lang, w AS w1, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
  FROM w WINDOW o AS (PARTITION BY i ORDER BY pos)),
c AS (
  SELECT lang, 1 AS k, w1 AS gram, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS gram, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING f >= 100
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS gram, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING f >= 100
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS gram, count(*) AS f FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING f >= 100
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 AS gram, count(*) AS f FROM g WHERE w5 IS NOT NULL
    GROUP BY ALL HAVING f >= 100),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM c WHERE k = 1 GROUP BY lang),
cut AS (SELECT c.lang, k, gram, f AS a, j,
    array_to_string(string_split(gram, ' ')[1:j], ' ') AS first, array_to_string(string_split(gram, ' ')[j + 1:], ' ') AS rest
  FROM c, (SELECT unnest([1, 2, 3, 4]) AS j) WHERE k > 1 AND j < k),
s AS (SELECT cut.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN c x ON x.lang = cut.lang AND x.gram = first JOIN c y ON y.lang = cut.lang AND y.gram = rest JOIN n ON n.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1),
inside AS (SELECT DISTINCT x.lang, x.gram FROM c y JOIN c x ON x.lang = y.lang AND x.k < y.k AND x.k > 1 AND 100 * y.f >= 100 * x.f
  AND contains(' ' || y.gram || ' ', ' ' || x.gram || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank, gram AS phrase,
  a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM b ANTI JOIN inside USING (lang, gram) QUALIFY rank <= 2000
"""


@query("op13_phrase_collocations", SQL)
def op13_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
