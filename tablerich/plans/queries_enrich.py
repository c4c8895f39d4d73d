"""Queries: enrichment dataflow."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tablerich.operators import costs
from tablerich.operators import enrich as E
from tablerich.operators import ordering as O
from tablerich.operators.naming import OutputColumn
from tablerich.operators.resolvers import ExprResolver, TableResolver
from tablerich.plans import jobs
from tablerich.plans.catalog import query, table
from tablerich.session import scratch_path
from tablerich.sources import writers

COUNTRY, REGION = "Country name", "Region name (continent)"


def places(spark, sf):
    """Nations with their region: the knowledge table of most queries."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def place_resolver(spark, sf, knowledge=None, **kw):
    known = places(spark, sf) if knowledge is None else knowledge
    return TableResolver(
        known, {"country": "n_nationkey"}, {"country_name": "n_name", "region_name": "r_name"}, unique=True, **kw
    )


def customer_resolver(spark, sf, where=None):
    known = table(spark, sf, "customer").join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    if where is not None:
        known = known.filter(where)
    return TableResolver(
        known,
        {"customer": "c_custkey"},
        {"customer_name": "c_name", "segment": "c_mktsegment", "country": "n_name"},
        unique=True,
    )


CUSTOMER_OUTPUTS = ["Customer name", "Segment [market]", "Country"]
ORDER_INPUTS = {"customer": "o_custkey"}
PLACES_SQL = "nation JOIN region ON n_regionkey = r_regionkey"


def flagship(spark, sf):
    """Suppliers with country, region and order volume."""
    # Decimals, so that the sum does not depend on the order of its rows.
    paid = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    volume = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(paid).alias("volume"))
    suppliers = table(spark, sf, "supplier")
    known = (
        suppliers.select(F.col("s_suppkey").alias("k_suppkey"), F.col("s_nationkey").alias("k_nationkey"))
        .join(places(spark, sf), F.col("k_nationkey") == F.col("n_nationkey"))
        .join(volume, F.col("k_suppkey") == F.col("l_suppkey"), "left")
    )
    resolver = TableResolver(
        known,
        {"company": "k_suppkey"},
        {"country_name": "n_name", "region_name": "r_name", "order_volume": F.col("volume")},
        unique=True,
    )
    outputs = [COUNTRY, REGION, OutputColumn("order_volume", "Order volume (USD)", "float")]
    return E.enrich(suppliers, {"company": "s_suppkey", "company_name": "s_name"}, outputs, resolver).table()


query(
    "enrich_suppliers",
    f"""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, n_name AS country_name, r_name AS region_name,
       v.volume AS order_volume
FROM supplier LEFT JOIN ({PLACES_SQL}) ON s_nationkey = n_nationkey
LEFT JOIN (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
             AS DOUBLE) AS volume FROM lineitem GROUP BY l_suppkey) v ON s_suppkey = l_suppkey""",
)(flagship)


@query(
    "enrich_batch",
    f"""
SELECT c_custkey, CASE WHEN n_nationkey IS NULL THEN 'failed' ELSE 'completed' END AS status,
       '{{"country_name":"' || n_name || '","region_name":"' || r_name || '"}}' AS answer,
       CASE WHEN n_nationkey IS NULL THEN 'No result' END AS error
FROM customer LEFT JOIN (SELECT * FROM {PLACES_SQL} WHERE r_name <> 'EUROPE') ON c_nationkey = n_nationkey""",
)
def enrich_batch(spark, sf):
    known = places(spark, sf).filter(F.col("r_name") != "EUROPE")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    done = E.enrich(customers, {"country": "c_nationkey"}, [COUNTRY, REGION], place_resolver(spark, sf, known))
    return done.results().drop("c_nationkey")


@query(
    "enrich_single",
    f"""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, n_name AS country_name, r_name AS region_name
FROM (SELECT * FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 1)
LEFT JOIN ({PLACES_SQL}) ON s_nationkey = n_nationkey""",
)
def enrich_single(spark, sf):
    one = table(spark, sf, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(1)
    return E.enrich(one, {"country": "s_nationkey"}, [COUNTRY, REGION], place_resolver(spark, sf)).table()


@query(
    "enrich_table",
    """
SELECT o_orderkey, o_custkey, o_totalprice, c_name AS customer_name, c_mktsegment AS segment, n_name AS country
FROM orders LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey""",
)
def enrich_table(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return E.enrich(orders, ORDER_INPUTS, CUSTOMER_OUTPUTS, customer_resolver(spark, sf)).table()


@query(
    "enrich_filtered",
    """
SELECT o_orderkey, o_custkey, c_name AS customer_name, c_mktsegment AS segment, n_name AS country
FROM orders LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey
WHERE o_totalprice > 250000""",
)
def enrich_filtered(spark, sf):
    orders = table(spark, sf, "orders")
    done = E.enrich(
        orders, ORDER_INPUTS, CUSTOMER_OUTPUTS, customer_resolver(spark, sf), where=F.col("o_totalprice") > 250000
    )
    return done.table().select("o_orderkey", "o_custkey", "customer_name", "segment", "country")


@query(
    "enrich_errors",
    """
SELECT o_orderkey, o_custkey, 'No result' AS error FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def enrich_errors(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    resolver = customer_resolver(spark, sf, F.col("c_acctbal") > 0)
    return E.enrich(orders, ORDER_INPUTS, CUSTOMER_OUTPUTS, resolver).errors()


@query(
    "enrich_metrics",
    """
SELECT count(*) AS total_count, count(c_custkey) AS success_count, count(*) - count(c_custkey) AS error_count
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def enrich_metrics(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    resolver = customer_resolver(spark, sf, F.col("c_acctbal") > 0)
    return E.enrich(orders, ORDER_INPUTS, CUSTOMER_OUTPUTS, resolver).metrics()


def _basis():
    page = F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string"))
    entry = lambda field, text: F.struct(
        F.lit(field).alias("field"),
        F.array(F.struct(page.alias("url"), F.array(text).alias("excerpts"))).alias("citations"),
        F.lit(None).cast("string").alias("reasoning"),
        F.when(F.col("r_name") == "ASIA", "high").otherwise("medium").alias("confidence"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("array<string>").alias("excerpts"),
    )
    return F.array(entry("country_name", F.col("n_name")), entry("region_name", F.col("r_name")))


def _with_basis(spark, sf):
    known = places(spark, sf).filter(F.col("r_name") != "EUROPE")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    resolver = place_resolver(spark, sf, known, basis=_basis())
    return E.enrich(customers, {"country": "c_nationkey"}, [COUNTRY, REGION], resolver).table(include_basis=True)


@query(
    "enrich_with_basis",
    f"""
WITH k AS (SELECT *, CASE WHEN r_name = 'ASIA' THEN 'high' ELSE 'medium' END AS sure FROM {PLACES_SQL}
           WHERE r_name <> 'EUROPE')
SELECT c_custkey, n_name AS country_name, r_name AS region_name,
  '[{{"field":"country_name","citations":[{{"url":"nation:' || n_nationkey || '","excerpts":["' || n_name
  || '"]}}],"confidence":"' || sure || '"}},{{"field":"region_name","citations":[{{"url":"nation:' || n_nationkey
  || '","excerpts":["' || r_name || '"]}}],"confidence":"' || sure || '"}}]' AS _basis
FROM customer LEFT JOIN k ON c_nationkey = n_nationkey""",
)
def enrich_with_basis(spark, sf):
    return _with_basis(spark, sf).select(
        "c_custkey", "country_name", "region_name", F.to_json("_basis").alias("_basis")
    )


@query(
    "citations_flat",
    f"""
WITH k AS (SELECT c_custkey, n_nationkey, n_name, r_name, CASE WHEN r_name = 'ASIA' THEN 'high' ELSE 'medium' END AS sure
           FROM customer JOIN ({PLACES_SQL}) ON c_nationkey = n_nationkey WHERE r_name <> 'EUROPE')
SELECT c_custkey, 'country_name' AS field, 'nation:' || n_nationkey AS url, n_name AS excerpt, sure AS confidence FROM k
UNION ALL SELECT c_custkey, 'region_name', 'nation:' || n_nationkey, r_name, sure FROM k""",
)
def citations_flat(spark, sf):
    return E.citations(_with_basis(spark, sf), "_basis", ["c_custkey"])


@query(
    "chunk_sizes",
    """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1),
x AS (SELECT o_orderpriority, n, unnest(range(1, CAST(ceil(n / 1000.0) AS BIGINT) + 1)) AS chunk FROM c)
SELECT o_orderpriority, chunk, CAST(least(1000, n - (chunk - 1) * 1000) AS BIGINT) AS rows FROM x""",
)
def chunk_sizes(spark, sf):
    return O.chunk_sizes(table(spark, sf, "orders"), ["o_orderpriority"]).withColumn("rows", F.col("rows").cast("bigint"))


@query(
    "batch_ids",
    """
SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderdate, o_orderkey) / 100.0) AS BIGINT) AS batch_id
FROM orders""",
)
def batch_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return O.batch_ids(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch_id")


@query(
    "batch_slice",
    """
SELECT c_custkey, c_name FROM (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn
FROM customer) WHERE rn BETWEEN 101 AND 200""",
)
def batch_slice(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return O.batch_slice(customers, [F.desc("c_acctbal"), F.asc("c_custkey")], 2).select("c_custkey", "c_name")


@query(
    "batches_union",
    f"""
SELECT c_custkey, n_name AS country_name, r_name AS region_name,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band
FROM customer LEFT JOIN ({PLACES_SQL}) ON c_nationkey = n_nationkey""",
)
def batches_union(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    balance = F.col("c_acctbal")
    bands = {"debt": balance < 0, "low": (balance >= 0) & (balance < 5000), "high": balance >= 5000}
    out = None
    for band, where in bands.items():
        done = E.enrich(
            customers, {"country": "c_nationkey"}, [COUNTRY, REGION], place_resolver(spark, sf), where=where
        ).table().select("c_custkey", "country_name", "region_name", F.lit(band).alias("band"))
        out = done if out is None else out.unionByName(done)
    return out


def label_rows(rows, names):
    """Resolver of the partitioned queries: upper-case name and the size of the row's group."""
    return [{"label": r["name"].upper(), "group_rows": r.get("group_rows")} for r in rows]


@query(
    "enrich_partitioned",
    """
SELECT c_nationkey, c_custkey,
  '{"label":"' || upper(c_name) || '","group_rows":"' || count(*) OVER (PARTITION BY c_nationkey) || '"}' AS enriched
FROM customer""",
)
def enrich_partitioned(spark, sf):
    customers = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_name")
    return E.enrich_partitioned(
        customers, ["c_nationkey"], ["c_custkey"], {"name": "c_name"}, ["Label", "Group rows"], label_rows
    )


_INPUT = """CASE WHEN c_acctbal < 0 THEN 'not json' WHEN c_nationkey = 0 THEN '{"nation":"none"}'
  ELSE '{"nation":"' || c_nationkey || '"}' END"""
_ASKED = """CASE c_mktsegment WHEN 'BUILDING' THEN '["Country name"]'
  WHEN 'MACHINERY' THEN '["Country name","Region name (continent)"]' WHEN 'HOUSEHOLD' THEN 'Region name'
  WHEN 'AUTOMOBILE' THEN NULL ELSE '["Region name"]' END"""


@query(
    "enrich_mixed_outputs",
    f"""
SELECT c_custkey, CASE
    WHEN c_mktsegment = 'AUTOMOBILE' THEN '{{"error":"Invalid arguments"}}'
    WHEN c_acctbal < 0 THEN '{{"error":"Invalid input JSON"}}'
    WHEN c_nationkey = 0 THEN '{{"error":"No result"}}'
    WHEN c_mktsegment = 'BUILDING' THEN '{{"country_name":"' || n_name || '"}}'
    WHEN c_mktsegment = 'MACHINERY' THEN '{{"country_name":"' || n_name || '","region_name":"' || r_name || '"}}'
    ELSE '{{"region_name":"' || r_name || '"}}' END AS reply
FROM customer JOIN ({PLACES_SQL}) ON c_nationkey = n_nationkey""",
)
def enrich_mixed_outputs(spark, sf):
    calls = table(spark, sf, "customer").select(
        "c_custkey", F.expr(_INPUT).alias("input"), F.expr(_ASKED).alias("asked")
    )
    known = places(spark, sf).withColumn("nation_text", F.col("n_nationkey").cast("string"))
    replies = E.enrich_requested(
        calls, "input", "asked", {"nation": "nation_text"}, {"country_name": "n_name", "region_name": "r_name"}, known
    )
    return replies.select("c_custkey", "reply")


BIG_SPENDERS = """SELECT o_custkey, count(*) FILTER (o_totalprice > 400000) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (o_totalprice > 400000) AS DOUBLE) AS total
  FROM orders GROUP BY 1 HAVING n > 0"""


def spend_resolver(spark, sf, key="customer"):
    """Large orders per customer, out of all orders; customers with small ones only have null answers."""
    large = F.col("o_totalprice") > 400000
    known = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.nullif(F.count_if(large), F.lit(0)).alias("n"),
            F.sum(F.when(large, F.col("o_totalprice").cast("decimal(12,2)"))).alias("total"),
        )
        .hint("rebalance")
    )
    return TableResolver(known, {key: "o_custkey"}, {"order_count": "n", "order_total": "total"}, unique=True)


SPEND_COLUMNS = [
    OutputColumn("order_count", "Number of large orders", "int"),
    OutputColumn("order_total", "Sum of large orders (USD)", "float"),
]


@query(
    "typed_job",
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer, c_name AS name, n AS order_count, total AS order_total
FROM customer JOIN ({BIG_SPENDERS}) ON c_custkey = o_custkey""",
)
def typed_job(spark, sf):
    customers = table(spark, sf, "customer")
    good, _ = E.typed_job(
        customers, {"customer": "c_custkey", "name": "c_name"}, SPEND_COLUMNS, spend_resolver(spark, sf), stamp=False
    )
    return good


def _spend_config(source: str, kind: str, key: str, name: str) -> dict:
    return {
        "source": source,
        "target": "enriched",
        "source_type": kind,
        "processor": "core-fast",
        "source_columns": [{"name": key, "description": "Customer key"}, {"name": name, "description": "Name"}],
        "enriched_columns": [
            {"name": c.name, "description": c.description, "type": c.type} for c in SPEND_COLUMNS
        ],
    }


@query(
    "job_from_config",
    f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, n AS order_count, total AS order_total
FROM customer JOIN ({BIG_SPENDERS}) ON c_custkey = o_custkey""",
)
def job_from_config(spark, sf):
    config = jobs.parse_config(_spend_config(f"{sf}/customer.parquet", "parquet", "c_custkey", "c_name"))
    good, _ = jobs.build_job(spark, config, spend_resolver(spark, sf, "c_custkey"), stamp=False)
    return good


@query(
    "dry_run",
    """
SELECT 'customer_source' AS source, 'enriched' AS target, 'core-fast' AS processor, 'c_custkey, c_name' AS inputs,
       'order_count, order_total' AS outputs, count(*) AS rows FROM customer""",
)
def dry_run(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    config = jobs.parse_config(_spend_config("customer_source", "table", "c_custkey", "c_name"))
    return jobs.dry_run(spark, config)


@query(
    "multi_job",
    f"""
WITH r AS (SELECT o_custkey, n, total FROM ({BIG_SPENDERS}))
SELECT 'customers' AS job, 'success' AS status, CAST(NULL AS VARCHAR) AS error, count(*) AS rows
FROM customer JOIN r ON c_custkey = o_custkey
UNION ALL SELECT 'buyers', 'success', NULL, count(*) FROM orders JOIN r USING (o_custkey)
UNION ALL SELECT 'broken', 'failed', 'missing: source_columns', 0""",
)
def multi_job(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    table(spark, sf, "orders").createOrReplaceTempView("orders_source")
    sources = {
        "customers": "SELECT c_custkey AS id, c_name AS label FROM customer_source",
        "buyers": "SELECT o_custkey AS id, o_orderpriority AS label FROM orders_source",
    }
    configs = []
    for name, select in sources.items():
        path = scratch_path(spark, f"source-{name}")
        spark.sql(select).write.parquet(path)
        configs.append((name, {**_spend_config(path, "parquet", "id", "label"), "target": scratch_path(spark, f"target-{name}")}))
    broken = _spend_config("customer_source", "table", "id", "label")
    del broken["source_columns"]
    _, status = jobs.run_many(spark, [*configs, ("broken", broken)], spend_resolver(spark, sf, "id"))
    return status.select("job", "status", "error", "rows")


@query(
    "job_round_trip",
    """
SELECT format, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(length(c_name) AS BIGINT) AS letters,
       c_mktsegment || ';' || upper(c_mktsegment) AS segments
FROM customer, (VALUES ('json'), ('csv')) AS f(format)""",
)
def job_round_trip(spark, sf):
    """All customers through a job from JSON lines and one from CSV, each read back from what the job has written."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    segment = F.col("c_mktsegment")
    resolver = ExprResolver({"letters": F.length("c_name"), "segments": F.array(segment, F.upper(segment))})
    out = None
    for kind in ("json", "csv"):
        source, target = (scratch_path(spark, f"{end}-{kind}") for end in ("source", "target"))
        (writers.write_json if kind == "json" else writers.write_csv)(customers, source)
        config = {
            "source": source, "target": target, "source_type": kind,
            "source_columns": [{"name": c, "description": c} for c in customers.columns],
            "enriched_columns": [
                {"name": "letters", "description": "Letters of the name", "type": "int"},
                {"name": "segments", "description": "Segment in both cases", "type": "list[str]"},
            ],
        }
        jobs.run_job(spark, config, resolver)
        back = jobs.read_job(spark, replace(jobs.parse_config(config), source=target))
        listed = F.col("segments") if kind == "json" else F.from_json("segments", "array<string>")
        rows = back.select(
            F.lit(kind).alias("format"), "c_custkey", "c_name", F.col("letters").cast("bigint").alias("letters"),
            F.array_join(listed, ";").alias("segments"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


_TIER = """CASE o_orderpriority WHEN '1-URGENT' THEN 'pro-fast' WHEN '2-HIGH' THEN 'core' WHEN '3-MEDIUM' THEN 'base'
  WHEN '5-LOW' THEN 'lite-fast' ELSE 'ultra8x' END"""


@query(
    "cost_estimate",
    f"""
WITH t(processor, price, lo, hi) AS (VALUES ('pro-fast', 0.10, 30, 300), ('core', 0.025, 60, 300), ('base', 0.01, 15, 100),
  ('lite-fast', 0.005, 10, 20), ('ultra8x', NULL, 300, 7200)),
r AS (SELECT {_TIER} AS processor, count(*) AS n FROM orders GROUP BY 1)
SELECT r.processor, n AS rows, CAST(n * CAST(price AS DECIMAL(6,3)) AS DOUBLE) AS cost, CAST(lo AS BIGINT) AS min_seconds,
       CAST(hi AS BIGINT) AS max_seconds
FROM r LEFT JOIN t ON r.processor = t.processor""",
)
def cost_estimate(spark, sf):
    return costs.estimate(table(spark, sf, "orders").select(F.expr(_TIER).alias("processor")))


@query(
    "enrich_incremental",
    """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'cached ' || c_name ELSE c_name END AS customer_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def enrich_incremental(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    resolver = customer_resolver(spark, sf)
    old = E.enrich(
        orders, ORDER_INPUTS, ["Customer name"], resolver, where=F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    ).table()
    cache = old.select("o_orderkey", F.concat(F.lit("cached "), "customer_name").alias("customer_name"))
    return E.enrich_new(orders, cache, ["o_orderkey"], ORDER_INPUTS, ["Customer name"], resolver)


@query(
    "enrich_followup",
    f"""
SELECT c_custkey, CASE WHEN n IS NULL THEN '' ELSE 'orders=' || n || ';' END || 'name=' || c_name || ';segment='
  || lower(c_mktsegment) AS context
FROM customer LEFT JOIN ({BIG_SPENDERS}) ON c_custkey = o_custkey""",
)
def enrich_followup(spark, sf):
    customers = table(spark, sf, "customer")
    good, _ = E.typed_job(
        customers, {"customer": "c_custkey", "segment": "c_mktsegment"}, SPEND_COLUMNS[:1], spend_resolver(spark, sf),
        stamp=False,
    )
    earlier = good.select(
        F.col("customer").cast("bigint").alias("key"),
        F.create_map(F.lit("orders"), F.col("order_count").cast("string"), F.lit("segment"), F.col("segment")).alias("known"),
    )
    asked = customers.select(
        "c_custkey", F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.lower("c_mktsegment")).alias("input")
    )
    merged = E.with_context(asked, earlier.withColumnRenamed("key", "c_custkey"), "c_custkey", "input", "known")
    pairs = F.transform(F.map_entries("input"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return merged.select("c_custkey", F.array_join(pairs, ";").alias("context"))
