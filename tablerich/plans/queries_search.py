"""Queries: search, page extraction and research reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.operators import extract as X
from tablerich.operators import ordering as O
from tablerich.operators import report as R
from tablerich.operators import search as S
from tablerich.operators.index import StoredIndex
from tablerich.plans.catalog import query, table
from tablerich.session import scratch_path
from tablerich.plans.queries_ledger import bm25_sql

SEARCHES = ["the thion heres and", "nicht aulich sch", "que eau des", "und estion"]


def documents(spark, sf):
    df = table(spark, sf, "documents").withColumn("title", F.split("text", "\n", 2)[0])
    return S.Corpus(df.select("doc_id", "text", "title", "lang"), id="doc_id", text="text", title="title", location="lang", unique=True)


def _top(score: str, limit: int) -> str:
    return (
        f"SELECT query_no, id AS doc_id, {score} AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() "
        f"OVER (PARTITION BY query_no ORDER BY {score} DESC, id) AS rank FROM scored) WHERE rank <= {limit}"
    )


@query("search_bm25", f"WITH {bm25_sql('documents', 'doc_id', 'text', SEARCHES)} {_top('score', 10)}")
def search_bm25(spark, sf):
    found = S.rank_documents(documents(spark, sf), S.resolve_queries(None, SEARCHES))
    return found.select("query_no", "doc_id", "score", "rank")


@query("search_stored", f"WITH {bm25_sql('documents', 'doc_id', 'text', SEARCHES)} {_top('score', 10)}")
def search_stored(spark, sf):
    """The same request to an index that is built once and read by every search."""
    index = StoredIndex.build(documents(spark, sf), scratch_path(spark, "index"))
    return index.rank_keys(S.resolve_queries(None, SEARCHES))


_TABLE_SQL = r"""
WITH q AS (SELECT item_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> ''))) AS term
  FROM benchmark),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents),
st AS (SELECT count(*) AS n, avg(len(w)) AS a FROM d),
tf AS (SELECT doc_id, t AS term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT term FROM q) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / a))), 6) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN d USING (doc_id) CROSS JOIN st GROUP BY 1, 2)
SELECT item_id, doc_id, score, CAST(rank AS INTEGER) AS rank, left(text, 200) AS excerpt FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored) JOIN documents USING (doc_id) WHERE rank <= 10"""


@query("search_table", _TABLE_SQL)
def search_table(spark, sf):
    """Every row of a table of queries against all documents; text is read for the results only."""
    corpus = documents(spark, sf)
    index = StoredIndex.build(corpus, scratch_path(spark, "index"))
    found = index.rank_table(table(spark, sf, "benchmark"), "item_id", "text")
    texts = corpus.df.select("doc_id", F.left("text", F.lit(200)).alias("excerpt"))
    return texts.join(found, "doc_id").select("item_id", "doc_id", "score", "rank", "excerpt")


_TITLE_BONUS = r"""
, tt AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(string_split(text, chr(10))[1]),
           '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents),
bonus AS (SELECT query_no, tt.id, sum(0.5 * ln(1 + (n - df + 0.5) / (df + 0.5))) AS b
          FROM q JOIN df ON q.term = df.term JOIN tt ON list_contains(tt.w, q.term) CROSS JOIN st GROUP BY 1, 2),
raw AS (SELECT q.query_no, tf.id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
               / (tf + 1.2 * (0.25 + 0.75 * len(w) / a))) AS s
        FROM q JOIN tf ON q.term = tf.term JOIN df ON q.term = df.term JOIN d ON d.id = tf.id CROSS JOIN st GROUP BY 1, 2),
boosted AS (SELECT raw.query_no, raw.id, round(s + coalesce(b, 0), 6) AS score
            FROM raw LEFT JOIN bonus ON raw.query_no = bonus.query_no AND raw.id = bonus.id),
ranked AS (
  SELECT 'turbo' AS mode, query_no, id, CAST(overlap AS DOUBLE) AS score FROM scored
  UNION ALL SELECT 'basic', query_no, id, score FROM scored
  UNION ALL SELECT 'advanced', query_no, id, score FROM boosted)
SELECT mode, query_no, id AS doc_id, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY mode, query_no ORDER BY score DESC, id) AS rank FROM ranked) WHERE rank <= 10"""


@query("search_mode", f"WITH {bm25_sql('documents', 'doc_id', 'text', SEARCHES)} {_TITLE_BONUS}")
def search_mode(spark, sf):
    corpus = documents(spark, sf)
    counted = S.count_terms(corpus, S.request_terms(SEARCHES), titled=True)
    out = None
    for label, mode in {"turbo": "turbo", "basic": "one-shot", "advanced": "agentic"}.items():
        found = S.rank_keys(corpus, SEARCHES, mode=mode, counted=counted).select(
            F.lit(label).alias("mode"), "query_no", "doc_id", "score", "rank"
        )
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "search_budget",
    f"""
WITH {bm25_sql('documents', 'doc_id', 'text', SEARCHES)},
top AS ({_top('score', 10)}),
cut AS (SELECT query_no, rank, top.doc_id, left(text, 1000) AS x FROM top JOIN documents ON top.doc_id = documents.doc_id),
run AS (SELECT *, 5000 - coalesce(sum(length(x)) OVER (PARTITION BY query_no ORDER BY rank
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM cut)
SELECT query_no, rank, doc_id, left(x, CAST(room AS BIGINT)) AS excerpt FROM run WHERE room > 0""",
)
def search_budget(spark, sf):
    found = S.search(documents(spark, sf), queries=SEARCHES, total=5000)
    return found.select("query_no", "rank", "doc_id", "excerpt")


@query(
    "search_location",
    f"WITH {bm25_sql('''(SELECT * FROM documents WHERE lang = 'fr')''', 'doc_id', 'text', [SEARCHES[2]])} "
    f"{_top('score', 10)}",
)
def search_location(spark, sf):
    found = S.search(documents(spark, sf), objective=SEARCHES[2], location="FR")
    return found.select("query_no", "doc_id", "score", "rank")


_HOST = "lower(regexp_extract(url, '^https?://([^/:?#]+)', 1))"


@query(
    "search_domains",
    f"""
SELECT page_id, {_HOST} AS host FROM pages
WHERE ({_HOST} = 'example.com' OR {_HOST} LIKE '%.example.com' OR {_HOST} LIKE '%.example.org')
  AND NOT ({_HOST} = 'cheap-pills.example.com' OR {_HOST} LIKE '%.cheap-pills.example.com')""",
)
def search_domains(spark, sf):
    kept = S.domain_policy(
        table(spark, sf, "pages"), "url", ["example.com", "*.example.org"], ["cheap-pills.example.com"]
    )
    return kept.select("page_id", S.host(F.col("url")).alias("host"))


@query("search_after_date", "SELECT event_id, event_type, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20'")
def search_after_date(spark, sf):
    return S.after_date(table(spark, sf, "events"), "ts", "2024-01-20").select("event_id", "event_type", "ts")


@query(
    "freshness_policy",
    """
WITH a AS (SELECT event_id, CAST(floor((epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts)) / 1000000.0) AS BIGINT)
             AS age_seconds FROM events)
SELECT event_id, age_seconds, age_seconds > 604800 AS stale,
       CASE WHEN age_seconds > 604800 THEN 'stale_content' END AS error FROM a""",
)
def freshness_policy(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    now = events.agg(F.max("ts")).scalar()
    checked = S.freshness(events, "ts", now, 7 * 24 * 3600, allow_stale=False)
    return checked.select("event_id", "age_seconds", "stale", "error")


@query(
    "usage_totals",
    """
SELECT user_id, event_type AS name, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS count
FROM events GROUP BY 1, 2""",
)
def usage_totals(spark, sf):
    return S.usage_totals(
        table(spark, sf, "events"), "user_id", "event_type", F.get_json_object("props", "$.k").cast("bigint")
    )


@query(
    "usage_warnings",
    """
SELECT page_id, 'insecure url' AS warning FROM pages WHERE url LIKE 'http:%'
UNION ALL SELECT page_id, 'long page' FROM pages WHERE length(html) > 10000""",
)
def usage_warnings(spark, sf):
    checks = {"insecure url": F.col("url").startswith("http:"), "long page": F.length("html") > 10000}
    return S.warnings(table(spark, sf, "pages"), ["page_id"], checks)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# What the parser does to the markup these pages have, as replacements in order; ``$1`` is a group.
_TO_MARKDOWN = (
    (r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>|<!--.*?-->", " "),
    (r"(?is)<a\b[^>]*?\shref=\"([^\"]*)\"[^>]*>\s*(.*?)\s*</a\s*>", "[$2]($1)"),
    (r"<[hH]([1-6])\b[^>]*>", "\n\x01$1 "),
    (r"<(?:li|LI)\b[^>]*>", "\n- "),
    (r"(?i)</?(?:p|div|br|tr|ul|ol|table|article|section|nav|header|footer|h[1-6])\b[^>]*>", "\n"),
    (r"<[^>]+>", ""),
)
_HEADINGS = {f"\x01{level} ": "#" * level + " " for level in range(1, 7)}
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "\xa9", "&middot;": "\xb7", "&amp;": "&"}
_TIDY = ((r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n"))


def markdown_sql(c: str) -> str:
    for pattern, replacement in _TO_MARKDOWN:
        c = f"regexp_replace({c}, {quoted(pattern)}, {quoted(replacement.replace('$', chr(92)))}, 'g')"
    for plain, char in {**_HEADINGS, **_ENTITIES}.items():
        c = f"replace({c}, {quoted(plain)}, {quoted(char)})"
    for pattern, replacement in _TIDY:
        c = f"regexp_replace({c}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def title_sql() -> str:
    c = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
    for entity, char in _ENTITIES.items():
        c = f"replace({c}, {quoted(entity)}, {quoted(char)})"
    return rf"nullif(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '')"


@query(
    "extract_text",
    f"""
WITH p AS (SELECT url, {title_sql()} AS title, {markdown_sql('html')} AS content FROM pages)
SELECT url, title, content FROM p WHERE content <> ''""",
)
def extract_text(spark, sf):
    pages = table(spark, sf, "pages")
    results, _ = X.extract(pages.select("url"), pages, excerpts=False, full_content=True, unique=True)
    return results.select("url", "title", F.col("full_content").alias("content"))


_SECURE = "regexp_replace(url, '^http:', 'https:')"


@query(
    "extract_errors",
    f"""
SELECT DISTINCT {_SECURE} AS url, 'not_found' AS error_type, 404 AS http_status_code, CAST(NULL AS VARCHAR) AS content
FROM pages WHERE {_SECURE} NOT IN (SELECT url FROM pages)""",
)
def extract_errors(spark, sf):
    pages = table(spark, sf, "pages")
    requests = pages.select(F.expr(_SECURE).alias("url"))
    return X.extract(requests, pages, unique=True)[1]


@query(
    "extract_full",
    f"""
WITH p AS (SELECT url, {markdown_sql('html')} AS content FROM pages),
b AS (SELECT url, CAST(ceil(row_number() OVER (ORDER BY url) / 20.0) AS BIGINT) AS request FROM pages)
SELECT p.url, left(content, 1000) AS full_content, request FROM p JOIN b ON p.url = b.url WHERE content <> ''""",
)
def extract_full(spark, sf):
    pages = table(spark, sf, "pages")
    requests = O.batch_ids(pages.select("url"), ["url"], X.MAX_URLS).withColumnRenamed("batch_id", "request")
    results, _ = X.extract(requests, pages, excerpts=False, full_content=1000, unique=True)
    return results.join(requests, "url").select("url", "full_content", "request")


def excerpts_sql(id_: str, text: str, source: str, words: list[str], k: int) -> str:
    """CTEs ending in ``quoted (id, excerpts)``: the best sentences joined with `` | ``."""
    hits = " + ".join(f"(length(low) - length(replace(low, '{w}', ''))) // {len(w)}" for w in words)
    return rf"""
sent AS (SELECT id, generate_subscripts(x, 1) AS pos, unnest(x) AS s FROM (
  SELECT {id_} AS id, list_filter(list_transform(regexp_split_to_array(
    regexp_replace({text}, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'),
    lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '') AS x FROM {source})),
hit AS (SELECT id, pos, s, {hits} AS hits FROM (SELECT id, pos, s, lower(s) AS low FROM sent)),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY hits DESC, pos) AS rn FROM hit WHERE hits > 0),
quoted AS (SELECT id, string_agg(s, ' | ' ORDER BY pos) AS excerpts FROM best WHERE rn <= {k} GROUP BY 1)"""


FOCUS = ["the", "que", "und"]


@query(
    "extract_excerpts",
    f"""
WITH p AS (SELECT url, {markdown_sql('html')} AS content FROM pages),
{excerpts_sql('url', 'content', 'p', FOCUS, 3)}
SELECT url, coalesce(excerpts, '') AS excerpts FROM p LEFT JOIN quoted ON url = id WHERE content <> ''""",
)
def extract_excerpts(spark, sf):
    pages = table(spark, sf, "pages")
    results, _ = X.extract(pages.select("url"), pages, keywords=FOCUS, unique=True)
    return results.select("url", F.array_join("excerpts", " | ").alias("excerpts"))


QUESTIONS = ["nicht aulich", "heres estion thion"]


def _report_sql() -> str:
    parts = []
    for n, q in enumerate(QUESTIONS, 1):
        ctes = excerpts_sql("doc_id", "text", "documents", S.query_terms(q), 2)
        for name in ("sent", "hit", "best", "quoted"):
            ctes = ctes.replace(f"{name} AS", f"{name}{n} AS").replace(f"FROM {name} ", f"FROM {name}{n} ")
            ctes = ctes.replace(f"FROM {name})", f"FROM {name}{n})")
        parts.append(ctes)
    source = " UNION ALL ".join(f"SELECT {n} AS query_no, id, excerpts FROM quoted{n}" for n in (1, 2))
    asked = " ".join(f"WHEN {n} THEN {quoted(q)}" for n, q in enumerate(QUESTIONS, 1))
    return f"""
WITH {bm25_sql('documents', 'doc_id', 'text', QUESTIONS)},
{','.join(parts)},
found AS ({source}),
top AS ({_top('score', 3)})
SELECT top.query_no AS question_no, CASE top.query_no {asked} END AS question,
       string_agg(doc_id || ': ' || coalesce(excerpts, ''), chr(10) ORDER BY rank) AS report
FROM top LEFT JOIN found ON top.query_no = found.query_no AND top.doc_id = found.id GROUP BY 1, 2"""


@query("research_report", _report_sql())
def research_report(spark, sf):
    reports = R.research(QUESTIONS, documents(spark, sf))
    lines = F.transform("citations", lambda c: F.concat(c["source"], F.lit(": "), F.array_join(c["excerpts"], " | ")))
    return reports.select("question_no", "question", F.array_join(lines, "\n").alias("report"))
