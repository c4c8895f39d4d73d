"""Ranked text search over a corpus table: BM25, domain, date, location and excerpt policies.

A request holds a few queries typed by a user, so their terms are literals in the plan. Each document
is scored from its own row: there is no posting table, and only the best rows of each task are shuffled. ``index`` is for
many queries at once, and for a corpus that is searched again and again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.operators.inputs import moment
from tablerich.session import cut_lineage

K1 = 1.2
B = 0.75
TITLE_BOOST = 0.5
# Rows of a result that are sent to every task; more are joined by shuffling.
BROADCAST_ROWS = 100_000
# Limits of a request and names of modes.
MAX_DOMAINS = 200
MAX_RESULTS = 1000
MAX_OBJECTIVE_CHARS = 5000
MIN_EXCERPT_CHARS = 1000
DEFAULT_TOTAL_CHARS = 60_000
DEFAULT_RESULTS = 10
MIN_AGE_SECONDS = 600
SEARCH_MODES = {
    "turbo": "turbo",
    "fast": "fast",
    "basic": "basic",
    "advanced": "advanced",
    "one-shot": "basic",
    "agentic": "advanced",
}


@dataclass(frozen=True)
class Corpus:
    """A table of documents and the columns that play each part; ``id`` names one column or several.

    ``unique`` promises that no two rows share their ``id``.
    """

    df: DataFrame
    id: str | tuple[str, ...]
    text: str
    url: str | None = None
    title: str | None = None
    date: str | None = None
    location: str | None = None
    unique: bool = False

    @property
    def keys(self) -> list[str]:
        return [self.id] if isinstance(self.id, str) else list(self.id)


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def query_terms(query: str) -> list[str]:
    return sorted(set(re.findall(r"[^\W_]+", query.lower())))


def _frequencies(words: str, terms: Sequence[str]) -> Column:
    """Occurrences of each term in an array column, in term order. Terms hold letters and digits only."""
    return F.expr("array(" + ", ".join(f"size({words}) - size(array_remove({words}, '{t}'))" for t in terms) + ")")


def count_terms(corpus: Corpus, terms: Sequence[str], titled: bool = False) -> DataFrame:
    """Per document: its key, length ``_len`` and term counts ``_tf`` (``_ht`` for the title).

    The text is read and split once; the counts, a small part of its size, are kept in the shared
    folder for the two steps that need them: corpus statistics and scores.
    """
    text = {"_text": corpus.text, "_title": corpus.title} if titled else {"_text": corpus.text}
    narrow = corpus.df.select(*corpus.keys, *[F.coalesce(c, F.lit("")).alias(n) for n, c in text.items()])
    out = narrow.withColumn("_text", tokens(F.col("_text")))
    # Words that match no term are dropped before they are counted.
    hits = F.filter("_text", lambda w: w.isin(*terms))
    out = out.withColumns({"_len": F.size("_text"), "_text": hits})
    columns = [*corpus.keys, "_len", _frequencies("_text", terms).alias("_tf")]
    if titled:
        out = out.withColumn("_title", tokens(F.col("_title")))
        columns.append(_frequencies("_title", terms).alias("_ht"))
    return cut_lineage(out.select(*columns), "term-counts")


def _statistics(counted: DataFrame, n_terms: int) -> Column:
    """``struct<avg_len, idf array>`` of the corpus, as an uncorrelated scalar subquery."""
    found = ", ".join(f"count_if(_tf[{i}] > 0)" for i in range(n_terms))
    totals = counted.selectExpr("count(1) AS docs", "avg(_len) AS avg_len", f"array({found}) AS df")
    idf = "transform(df, d -> ln(1 + (docs - d + 0.5D) / (d + 0.5D)))"
    return totals.selectExpr(f"struct(avg_len, {idf} AS idf)").scalar()


def _score_sql(places: Sequence[int], how: str, titled: bool) -> str:
    """Score of one query over its terms, as an SQL expression (one parse instead of many columns)."""
    parts = []
    for i in places:
        if how == "turbo":
            parts.append(f"IF(_tf[{i}] > 0, 1.0D, 0.0D)")
            continue
        norm = f"{K1}D * ({1 - B}D + {B}D * _len / _s.avg_len)"
        parts.append(f"IF(_tf[{i}] > 0, _s.idf[{i}] * _tf[{i}] * {K1 + 1}D / (_tf[{i}] + {norm}), 0.0D)")
        if titled:
            parts.append(f"IF(_ht[{i}] > 0, {TITLE_BOOST}D * _s.idf[{i}], 0.0D)")
    return f"round({' + '.join(parts) or '0.0D'}, 6)"


def check_objective(objective: str) -> str:
    if len(objective) > MAX_OBJECTIVE_CHARS:
        raise ValueError(f"objective must have at most {MAX_OBJECTIVE_CHARS} characters")
    return objective


def resolve_queries(objective: str | None, queries: Sequence[str]) -> list[str]:
    """The queries of a request; an objective alone is its only query."""
    check_objective(objective or "")
    asked = [q for q in queries if q.strip()] or ([objective] if objective else [])
    if not asked:
        raise ValueError("give an objective or at least one query")
    return asked


def request_terms(queries: Sequence[str]) -> list[str]:
    """The distinct words of all queries of a request."""
    terms = sorted({t for q in queries for t in query_terms(q)})
    if not terms:
        raise ValueError("the queries hold no words")
    return terms


def rank_keys(
    corpus: Corpus, queries: Sequence[str], *, mode: str = "basic", limit: int = DEFAULT_RESULTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """The best ``limit`` documents of each query: ``(query_no, keys…, score, rank)``.

    ``counted`` is ``count_terms(corpus, request_terms(queries), …)``, when it is at hand already.
    """
    how = SEARCH_MODES.get(mode)
    if how is None:
        raise ValueError(f"mode must be one of {sorted(SEARCH_MODES)}")
    if not 1 <= limit <= MAX_RESULTS:
        raise ValueError(f"limit must be from 1 to {MAX_RESULTS}")
    terms = request_terms(queries)
    place = {t: i for i, t in enumerate(terms)}
    titled = how == "advanced" and corpus.title is not None
    scored = count_terms(corpus, terms, titled) if counted is None else counted
    if how != "turbo":
        scored = scored.withColumn("_s", _statistics(scored.select("_tf", "_len"), len(terms)))
    scores = ", ".join(
        f"struct({n} AS query_no, {_score_sql([place[t] for t in q], how, titled)} AS score)"
        for n, q in enumerate(map(query_terms, queries), 1)
    )
    rows = scored.select(*corpus.keys, F.expr(f"explode(filter(array({scores}), s -> s.score > 0))").alias("_q"))
    rows = rows.select("_q.query_no", *corpus.keys, "_q.score")
    if not corpus.unique:
        # Of documents that share their key the best one counts.
        best = _best_of_task(rows, corpus.keys, limit)
        rows = best.groupBy("query_no", *corpus.keys).agg(F.max("score").alias("score"))
    # Each task cuts its rows to ``limit`` per query before the shuffle.
    best = Window.partitionBy("query_no").orderBy(F.desc("score"), *corpus.keys)
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def _best_of_task(rows: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Of the rows of each task the best ``limit`` keys of every query, each with its best score."""
    columns, by = rows.columns, ["query_no", *keys]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            order = held.sort_values(["score", *keys], ascending=[False] + [True] * len(keys), na_position="first")
            held = order.drop_duplicates(by).groupby("query_no").head(limit)
        if held is not None:
            yield held[columns]

    return rows.mapInPandas(cut, rows.schema)


def rank_documents(
    corpus: Corpus, queries: Sequence[str], *, mode: str = "basic", limit: int = DEFAULT_RESULTS
) -> DataFrame:
    """``rank_keys`` with all corpus columns of the documents found."""
    top = rank_keys(corpus, queries, mode=mode, limit=limit)
    # Of documents that share their key one is returned.
    best = Window.partitionBy("query_no", *corpus.keys)
    if len(queries) * limit <= BROADCAST_ROWS:
        top = F.broadcast(top)
    if corpus.unique:
        return corpus.df.join(top, corpus.keys)
    found = corpus.df.join(top, corpus.keys).withColumn("_n", F.row_number().over(best.orderBy(corpus.text)))
    return found.filter("_n = 1").drop("_n")


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def check_domains(include: Sequence[str], exclude: Sequence[str]) -> None:
    if len(include) + len(exclude) > MAX_DOMAINS:
        raise ValueError(f"at most {MAX_DOMAINS} domains in all")


def in_domains(url_host: Column, domains: Sequence[str]) -> Column:
    """The host is one of the domains or lies below one."""
    hit = F.lit(False)
    for d in domains:
        d = d.lower().removeprefix("*.").strip(".")
        hit = hit | (url_host == d) | url_host.endswith("." + d)
    return hit


def domain_policy(df: DataFrame, url: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    check_domains(include, exclude)
    where = host(F.col(url))
    if include:
        df = df.filter(in_domains(where, include))
    if exclude:
        df = df.filter(~F.coalesce(in_domains(where, exclude), F.lit(False)))
    return df


def after_date(df: DataFrame, column: str, day: str | date) -> DataFrame:
    """Rows of the day or later; rows without a date are left out."""
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return df.filter(F.col(column) >= moment(day, df.schema[column].dataType))


def at_location(df: DataFrame, column: str, location: str) -> DataFrame:
    return df.filter(F.lower(column) == location.lower())


def freshness(
    df: DataFrame, fetched_at: str, now: Column, max_age_seconds: int, allow_stale: bool = True
) -> DataFrame:
    """Add ``age_seconds``, ``stale`` and ``error``; a stale row is an error when no fallback is allowed."""
    if max_age_seconds < MIN_AGE_SECONDS:
        raise ValueError(f"max age must be at least {MIN_AGE_SECONDS} seconds")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    age = F.floor((micros(now) - micros(F.col(fetched_at))) / 1_000_000)
    aged = df.withColumn("age_seconds", age).withColumn("stale", F.col("age_seconds") > max_age_seconds)
    failed = F.lit(None).cast("string") if allow_stale else F.when(F.col("stale"), "stale_content")
    return aged.withColumn("error", failed)


def budget_excerpts(
    results: DataFrame, text: str, *, per_result: int = MIN_EXCERPT_CHARS, total: int = DEFAULT_TOTAL_CHARS,
    by: Sequence[str] = ("query_no",), rank: str = "rank",
) -> DataFrame:
    """Add ``excerpt`` under a per-result and a total budget; results beyond the total are dropped."""
    if per_result < MIN_EXCERPT_CHARS:
        raise ValueError(f"per-result budget must be at least {MIN_EXCERPT_CHARS}")
    before = Window.partitionBy(*by).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    cut = results.withColumn("_x", F.left(text, F.lit(per_result)))
    left = F.lit(total) - F.coalesce(F.sum(F.length("_x")).over(before), F.lit(0))
    return (
        cut.withColumn("_left", left)
        .filter(F.col("_left") > 0)
        .withColumn("excerpt", F.left("_x", F.col("_left").cast("int")))
        .drop("_x", "_left")
    )


def _needed(column: str | None, part: str) -> str:
    if column is None:
        raise ValueError(f"the corpus names no {part} column")
    return column


def search(
    corpus: Corpus,
    *,
    objective: str | None = None,
    queries: Sequence[str] = (),
    mode: str = "basic",
    limit: int = DEFAULT_RESULTS,
    include_domains: Sequence[str] = (),
    exclude_domains: Sequence[str] = (),
    after: str | None = None,
    location: str | None = None,
    per_result: int = MIN_EXCERPT_CHARS,
    total: int = DEFAULT_TOTAL_CHARS,
) -> DataFrame:
    """One search request; filters are applied below the scoring, so they reach the scan."""
    df = corpus.df
    if include_domains or exclude_domains:
        df = domain_policy(df, _needed(corpus.url, "url"), include_domains, exclude_domains)
    if after:
        df = after_date(df, _needed(corpus.date, "date"), after)
    if location:
        df = at_location(df, _needed(corpus.location, "location"), location)
    ranked = rank_documents(
        replace(corpus, df=df), resolve_queries(objective, queries), mode=mode, limit=limit
    )
    return budget_excerpts(ranked, corpus.text, per_result=per_result, total=total)


def usage_totals(usage: DataFrame, session: str, name: str, count: Column) -> DataFrame:
    return usage.groupBy(session, F.col(name).alias("name")).agg(F.sum(count).alias("count"))


def warnings(df: DataFrame, key: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """One row per failed check: ``(key…, warning)``."""
    found = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for text, bad in checks.items()]))
    return df.select(*key, F.explode(found).alias("warning"))
