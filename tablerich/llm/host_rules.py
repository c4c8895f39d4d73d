"""Quality rules whose failures are judged by host.

``document_figures`` counts, from each whole text, what the rules look at. ``host_verdicts`` adds up the failures of
every rule by host (the ``source`` of a document). A host with few documents has a rate that says little, so rates are
shrunk: over all hosts of the corpus a beta distribution of rates is fitted by moments (mean: the corpus rate;
strength: from how much more the hosts differ than chance alone would make them), and a host's rate is the mean of
that prior updated by its own documents. A host is rejected when the shrunk rate of any rule is over ``LIMIT``.
``judged`` brings the verdicts back to the documents.

Figures are one narrow row per document, written once. Failures are added up in every task before the shuffle, so a
host with a third of all documents is a few rows there; the join back is by host, with the reduced side written, so
that Spark sees its size and splits a host with very many documents.

Null texts have no words and fail. A null ``source`` is a host like any other. Rows are judged one by one, repeated
ones too. Empty tables give no rows; extra columns are ignored. Hosts that all have one rate get the corpus rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablerich.llm.common import WORD, query, table, text_of
from tablerich.session import cut_lineage

SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 3
#: Shrunk failure rate above which a host is rejected.
LIMIT = 0.5
#: Least and greatest strength of the prior, in documents: no host is rejected for one document, and hosts that differ by no more
#: than chance share one rate.
WEAKEST, STRONGEST = 2.0, 1e6
FIGURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _covered(places: Column) -> Column:
    """Words in windows that start at these ascending places."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    step = lambda acc, p: F.struct(p.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total"))
    return F.aggregate(places, start, step, lambda acc: acc["total"])


def _with_equal_neighbour(values: Column, same) -> Column:
    """Of sorted values those that are the ``same`` as the one before or behind."""
    near = lambda x, other: F.coalesce(same(x, F.get(values, other)), F.lit(False))
    return F.filter(values, lambda x, i: near(x, i - 1) | near(x, i + 1))


def document_figures(docs: DataFrame) -> DataFrame:
    """``doc_id, source`` and the ``FIGURES`` of every row."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    split = docs.select("doc_id", "source", text_of().alias("text")).select(
        "doc_id", "source", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"), lines.alias("lines"),
        (F.size(F.split("text", f"[{SYMBOLS}]")) - 1).alias("n_symbols"),
    )
    words = F.col("words")
    begin = F.slice(words, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    at = lambda place: [F.get(words, place + k) for k in range(WINDOW)]
    # Windows sorted by 33 bits of their hash, each with its place in the other 31: equal ones are neighbours.
    placed = F.transform(begin, lambda w, i: F.shiftleft(F.xxhash64(*at(i)), 31).bitwiseOR(i.cast("bigint")))
    hashed = split.select("*", F.sort_array(placed).alias("placed"))
    alike = _with_equal_neighbour(F.col("placed"), lambda x, y: F.shiftrightunsigned(x.bitwiseXOR(y), 31) == 0)
    # Windows of another hash differ; those of an equal one are compared as texts.
    place = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    texts = F.transform(alike, lambda x: F.struct(F.concat_ws(" ", *at(place(x))).alias("gram"), place(x).alias("place")))
    grams = hashed.select("*", F.sort_array(texts).alias("grams"))
    twice = _with_equal_neighbour(F.col("grams"), lambda x, y: x["gram"] == y["gram"])
    figures = grams.select(
        "doc_id", "source", F.size(words).alias("n_words"), F.length(F.array_join(words, "")).alias("word_chars"), "n_symbols",
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _covered(F.sort_array(F.transform(twice, lambda x: x["place"]))).alias("n_repeat_words"),
    )
    return figures.select("doc_id", "source", *[F.col(c).cast("bigint").alias(c) for c in FIGURES])


#: What makes a document fail, in whole numbers of its figures.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_size": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE = ("short", "repeats")


def host_verdicts(figures: DataFrame, rules: dict[str, str] = RULES, limit: float = LIMIT) -> DataFrame:
    """``source, n``, for each rule ``rate_<rule>`` (shrunk), and ``rejected``, of every host."""
    counted = figures.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(test)).alias(name) for name, test in rules.items()]
    )
    hosts = cut_lineage(counted, "hosts")
    sums = [F.sum(F.col(name).cast("decimal(38,0)")).cast("double").alias(f"k_{name}") for name in rules]
    spread = [F.sum(F.col(name) * F.col(name).cast("double") / F.col("n")).alias(f"q_{name}") for name in rules]
    total = hosts.agg(
        F.count(F.lit(1)).alias("m"), F.sum(F.col("n").cast("double")).alias("n"),
        F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"), *sums, *spread,
    ).first()
    rates = []
    for name in rules:
        mean, strength = prior(total["m"], total["n"] or 0.0, total["nn"] or 0.0, total[f"k_{name}"] or 0.0, total[f"q_{name}"] or 0.0)
        rates.append(((F.col(name) + mean * strength) / (F.col("n") + strength)).alias(f"rate_{name}"))
    shrunk = hosts.select("source", "n", *rates)
    return shrunk.withColumn("rejected", F.greatest(*[F.col(f"rate_{name}") for name in rules], F.lit(0.0)) > limit)


def prior(hosts: int, n: float, nn: float, k: float, q: float) -> tuple[float, float]:
    """Mean and strength of the beta prior from sums over hosts: documents, their squares, failures, failures² / documents."""
    if not n:
        return 0.0, WEAKEST
    mean = k / n
    chance = mean * (1 - mean)
    room = n - nn / n - (hosts - 1)
    if chance <= 0 or room <= 0:
        return mean, WEAKEST
    alike = ((q - k * k / n) / chance - (hosts - 1)) / room
    return mean, STRONGEST if alike <= 1 / (STRONGEST + 1) else max(1 / alike - 1, WEAKEST)


def judged(docs: DataFrame, rules: dict[str, str] = RULES, base: tuple[str, ...] = BASE, limit: float = LIMIT) -> DataFrame:
    """``doc_id, source``, the figures, ``base_failed``, ``host_rejected`` and ``kept`` of every row."""
    figures = cut_lineage(document_figures(docs), "figures")
    verdicts = cut_lineage(host_verdicts(figures, rules, limit).select(F.col("source").alias("host"), "rejected"), "verdicts")
    failed = F.lit(False)
    for name in base:
        failed = failed | F.expr(rules[name])
    return figures.join(verdicts, F.col("source").eqNullSafe(F.col("host"))).select(
        "doc_id", "source", *FIGURES, failed.alias("base_failed"), F.col("rejected").alias("host_rejected"),
        (~failed & ~F.col("rejected")).alias("kept"),
    )


_RATE = """
  SELECT source, max((k + mean * strength) / (n + strength)) > 0.5 AS rejected FROM (
    SELECT source, n, k, mean, CASE WHEN mean * (1 - mean) <= 0 OR room <= 0 THEN 2.0
      WHEN alike <= 1.0 / 1000001 THEN 1e6 ELSE greatest(1 / alike - 1, 2.0) END AS strength
    FROM (SELECT *, CASE WHEN mean * (1 - mean) > 0 AND room > 0
        THEN ((q - kk * kk / nn) / (mean * (1 - mean)) - (m - 1)) / room END AS alike
      FROM (SELECT source, n, k, rule, sum(k) OVER r / sum(n) OVER r AS mean, count(*) OVER r AS m,
          sum(n) OVER r - sum(n * n) OVER r / sum(n) OVER r - (count(*) OVER r - 1) AS room,
          sum(k * k / n) OVER r AS q, sum(k) OVER r AS kk, sum(n) OVER r AS nn
        FROM (SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k FROM (
            SELECT source, unnest(['short', 'repeats', 'symbols', 'lines', 'word_size']) AS rule,
              unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
                10 * n_dup_lines > 3 * n_lines, word_chars < 2 * n_words OR word_chars > 15 * n_words]) AS failed
            FROM f) GROUP BY ALL)
        WINDOW r AS (PARTITION BY rule)))) GROUP BY source
"""

SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT i, unnest(ws) AS w, unnest(range(len(ws))) AS p
  FROM (SELECT i, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT i, p, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS gram FROM w WINDOW o AS (PARTITION BY i ORDER BY p)),
t AS (SELECT i, p FROM (SELECT i, p, gram, count(*) OVER (PARTITION BY i, gram) AS c FROM g WHERE gram IS NOT NULL) WHERE c > 1),
c AS (SELECT i, count(DISTINCT q) AS n_repeat_words FROM (SELECT i, unnest([p, p + 1, p + 2]) AS q FROM t) GROUP BY i),
l AS (SELECT i, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT i, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY i),
f AS (SELECT i, doc_id, source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN c USING (i) LEFT JOIN l USING (i)),
v AS ({_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT rejected AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


@query("op11_host_quality_rules", SQL)
def op11_host_quality_rules(spark, sf_dir):
    found = judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
