"""Queries: run ledger and memory of past runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.operators import ledger as L
from tablerich.operators import memory as M
from tablerich.plans.catalog import query, table
from tablerich.session import scratch_path

# Orders stand in for runs: F is completed, O running, P failed.
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END"


def order_ledger(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("group_id"),
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("input"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN o_totalprice END").alias("output"),
        F.expr("CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN concat('code ', o_orderpriority) END").alias(
            "error"
        ),
        F.expr(_STATUS).alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


@query("ledger_submit", "SELECT o_custkey AS group_id, count(*) AS num_runs FROM orders GROUP BY 1")
def ledger_submit(spark, sf):
    waiting = order_ledger(spark, sf).select("group_id", "run_id", "input")
    return L.submit(waiting)[1]


@query(
    "ledger_status",
    f"""
WITH c AS (SELECT o_custkey AS group_id, {_STATUS} AS status, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT group_id, CAST(sum(n) AS BIGINT) AS num_runs, bool_or(status = 'running') AS is_active,
       '{{' || string_agg('"' || status || '":' || n, ',' ORDER BY status) || '}}' AS status_counts
FROM c GROUP BY group_id""",
)
def ledger_status(spark, sf):
    return L.group_status(order_ledger(spark, sf))


@query(
    "ledger_collect",
    """
SELECT o_custkey AS group_id, o_orderkey AS run_id, o_orderpriority AS input,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS output,
       CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderstatus = 'P' AND o_totalprice > 100000
         THEN 'code ' || o_orderpriority ELSE 'No result' END AS error
FROM orders""",
)
def ledger_collect(spark, sf):
    return L.collect_results(order_ledger(spark, sf))


@query(
    "ledger_totals",
    """
SELECT o_custkey AS group_id, count(*) FILTER (o_orderstatus = 'F') AS completed,
       count(*) FILTER (o_orderstatus <> 'F') AS failed FROM orders GROUP BY 1""",
)
def ledger_totals(spark, sf):
    return L.totals(order_ledger(spark, sf))


@query(
    "ledger_classify",
    f"""
WITH r AS (SELECT o_custkey AS group_id, o_orderkey AS run_id, {_STATUS} AS status, o_orderpriority, o_totalprice,
             o_orderdate + INTERVAL 30 DAY < (SELECT max(o_orderdate) FROM orders) AS late FROM orders)
SELECT group_id, run_id, status,
  CASE status WHEN 'completed' THEN 'result' WHEN 'failed' THEN 'error' ELSE
    CASE WHEN late THEN 'timeout' ELSE 'waiting' END END AS outcome,
  CASE WHEN status = 'failed' AND o_totalprice > 100000 THEN 'code ' || o_orderpriority
       WHEN status = 'failed' THEN 'run failed'
       WHEN status = 'running' AND late THEN 'timed out after 2592000s' END AS message
FROM r""",
)
def ledger_classify(spark, sf):
    now = table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()
    return L.classify(order_ledger(spark, sf), now, 30 * 24 * 3600)


@query(
    "ledger_latest",
    """
SELECT run_id, l_shipdate, l_linenumber, l_suppkey, l_quantity FROM (
  SELECT l_orderkey AS run_id, l_shipdate, l_linenumber, l_suppkey, l_quantity, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def ledger_latest(spark, sf):
    versions = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), "l_shipdate", "l_linenumber", "l_suppkey", "l_quantity"
    )
    return L.latest(versions, "run_id", ["l_shipdate", "l_linenumber"])


@query(
    "ledger_cancel",
    f"""
SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'cancelled' ELSE {_STATUS} END AS status, o_orderpriority AS input
FROM orders""",
)
def ledger_cancel(spark, sf):
    """Urgent runs are cancelled; those that have ended already stay as they are."""
    versions = order_ledger(spark, sf).select("run_id", F.lit(1).alias("version"), "status", "input")
    wanted = versions.filter(F.col("input") == "1-URGENT")
    return L.latest(versions.unionByName(L.cancel(L.latest(versions, "run_id", ["version"]), wanted, "version")), "run_id", ["version"])


@query(
    "run_progress",
    """
WITH c AS (SELECT o_orderpriority, o_orderdate AS step, count(*) FILTER (o_orderstatus = 'F') AS c, count(*) AS n
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, step,
       CAST(sum(c) OVER (PARTITION BY o_orderpriority ORDER BY step) AS BIGINT) AS completed,
       CAST(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY step) AS BIGINT) AS total
FROM c""",
)
def run_progress(spark, sf):
    ledger = order_ledger(spark, sf).withColumnRenamed("input", "o_orderpriority")
    return L.progress(ledger, ["o_orderpriority"], F.col("created_at"))


# Conversations stand in for memory: user turns are tasks, assistant turns monitors, system turns discoveries.
_KIND = "CASE role WHEN 'user' THEN 'task' WHEN 'assistant' THEN 'monitor' ELSE 'discovery' END"


def entries(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("scope"),
        F.expr(_KIND).alias("kind"),
        F.col("turn").alias("id"),
        F.col("turn").alias("updated_at"),
        "text",
    )


@query(
    "memory_recent",
    f"""
SELECT conv_id AS scope, {_KIND} AS kind, turn AS id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rank FROM conversations) WHERE rank <= 3""",
)
def memory_recent(spark, sf):
    return M.recent_per_scope(entries(spark, sf), 3).select("scope", "kind", "id", "rank")


_MEMORY_QUERY = "the thion and que"


def bm25_sql(source: str, id_: str, text: str, queries: list[str]) -> str:
    """CTEs ending in ``scored (query_no, id, score)`` for literal queries."""
    from tablerich.operators.search import query_terms

    values = ", ".join(f"({n}, '{t}')" for n, q in enumerate(queries, 1) for t in query_terms(q))
    return rf"""
q(query_no, term) AS (VALUES {values}),
d AS (SELECT {id_} AS id, list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '') AS w
      FROM {source}),
st AS (SELECT count(*) AS n, avg(len(w)) AS a FROM d),
tf AS (SELECT id, t AS term, count(*) AS tf FROM (SELECT id, unnest(w) AS t FROM d)
       WHERE t IN (SELECT term FROM q) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT q.query_no, tf.id, count(*) AS overlap,
             round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / a))), 6) AS score
           FROM q JOIN tf ON q.term = tf.term JOIN df ON q.term = df.term JOIN d ON d.id = tf.id CROSS JOIN st
           GROUP BY 1, 2)"""


@query(
    "memory_relevant",
    f"""
WITH {bm25_sql('conversations', '(conv_id, turn)', 'text', [_MEMORY_QUERY])},
m AS (SELECT conv_id, turn, {_KIND} AS kind, score FROM scored JOIN conversations ON id = (conv_id, turn))
SELECT conv_id AS scope, kind, turn AS id, score FROM m ORDER BY score DESC, conv_id, kind, turn LIMIT 25""",
)
def memory_relevant(spark, sf):
    return M.relevant(entries(spark, sf), _MEMORY_QUERY, "text", 25).select("scope", "kind", "id", "score")


_LIVE = """(SELECT c.* FROM conversations c LEFT JOIN (
  SELECT conv_id, max(turn) AS cleared FROM conversations WHERE length(text) < 100 GROUP BY 1) x ON c.conv_id = x.conv_id
  WHERE role <> 'system' AND (cleared IS NULL OR turn > cleared))"""


@query(
    "memory_indexed",
    f"""
WITH {bm25_sql(_LIVE, '(conv_id, turn)', 'text', [_MEMORY_QUERY])},
m AS (SELECT conv_id, turn, {_KIND} AS kind, score FROM scored JOIN conversations ON id = (conv_id, turn))
SELECT conv_id AS scope, kind, turn AS id, score FROM m ORDER BY score DESC, conv_id, kind, turn LIMIT 25""",
)
def memory_indexed(spark, sf):
    """Memory kept in an index: turns of assistants come later, system turns are evicted, scopes are cleared."""
    kept = entries(spark, sf)
    memory = M.MemoryIndex.build(kept.filter("kind <> 'monitor'"), "text", scratch_path(spark, "memory"), unique=True)
    memory.add(kept.filter("kind = 'monitor'"), "text")
    memory.evict(kept.filter("kind = 'discovery'"))
    short = kept.filter(F.length("text") < 100)
    memory.clear(short.select("scope", F.col("updated_at").alias("cleared_at")))
    return memory.relevant(_MEMORY_QUERY, 25).select("scope", "kind", "id", "score")


@query(
    "memory_evict",
    f"SELECT conv_id AS scope, {_KIND} AS kind, turn AS id FROM conversations WHERE length(text) >= 100",
)
def memory_evict(spark, sf):
    all_entries = entries(spark, sf)
    short = all_entries.filter(F.length("text") < 100)
    return M.evict(all_entries, short).select("scope", "kind", "id")


@query(
    "memory_clear",
    f"""
SELECT c.conv_id AS scope, {_KIND} AS kind, turn AS id FROM conversations c
LEFT JOIN (SELECT conv_id, max(turn) AS cleared FROM conversations WHERE length(text) < 100 GROUP BY 1) x
  ON c.conv_id = x.conv_id
WHERE cleared IS NULL OR turn > cleared""",
)
def memory_clear(spark, sf):
    all_entries = entries(spark, sf)
    cleared = all_entries.filter(F.length("text") < 100).select("scope", F.col("updated_at").alias("cleared_at"))
    return M.clear(all_entries, cleared).select("scope", "kind", "id")


@query(
    "memory_preview",
    f"""
SELECT conv_id AS scope, {_KIND} AS kind, turn AS id,
  CASE role WHEN 'user' THEN text WHEN 'assistant' THEN 'Status: ' ||
    CASE WHEN length(text) > 200 THEN 'active' ELSE 'unknown' END
    ELSE 'Matched entities: ' || length(text) END AS line,
  CASE WHEN role = 'assistant' THEN 'e' || e END AS event_id, text AS input_excerpt,
  CASE WHEN role = 'assistant' THEN text END AS excerpt
FROM conversations, (VALUES (1), (2)) AS v(e) WHERE role = 'assistant' OR e = 1""",
)
def memory_preview(spark, sf):
    event = lambda n: F.struct(
        F.lit(f"e{n}").alias("event_id"), F.col("turn").alias("detected_at"), F.col("text").alias("excerpt")
    )
    full = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("scope"),
        F.expr(_KIND).alias("kind"),
        F.col("turn").alias("id"),
        F.col("turn").alias("updated_at"),
        F.col("text").alias("input_excerpt"),
        F.col("text").alias("output_excerpt"),
        F.length("text").alias("matched_count"),
        F.when(F.length("text") > 200, "active").alias("status"),
        F.array(event(1), event(2)).alias("matched_events"),
    )
    return M.preview_rows(full).select("scope", "kind", "id", "line", "event_id", "input_excerpt", "excerpt")
