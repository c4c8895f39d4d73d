"""Queries: entity discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.operators import discovery as D
from tablerich.operators.resolvers import TableResolver
from tablerich.operators.search import Corpus
from tablerich.plans.catalog import query, table
from tablerich.plans.queries_ledger import bm25_sql

_SIZE, _TYPE = "p_size BETWEEN 10 AND 30", "p_type = 'ECONOMY'"
_MATCH = f"({_SIZE}) AND {_TYPE}"


def parts(spark, sf, generator="pro", limit=25):
    return D.Discovery(
        objective="economy parts of medium size",
        entity_type="parts",
        entities=table(spark, sf, "part"),
        id="p_partkey",
        conditions=[
            D.Condition("size_ok", "size from 10 to 30", F.col("p_size").between(10, 30), F.col("p_size")),
            D.Condition("economy", "is an economy part", F.col("p_type") == "ECONOMY"),
        ],
        score=F.col("p_retailprice"),
        generator=generator,
        match_limit=limit,
    )


@query(
    "discovery_preview",
    f"""
SELECT 'parts' AS entity_type, 'size_ok' AS condition, 'size from 10 to 30' AS description,
       count(*) FILTER ({_SIZE}) AS entities FROM part
UNION ALL SELECT 'parts', 'economy', 'is an economy part', count(*) FILTER ({_TYPE}) FROM part""",
)
def discovery_preview(spark, sf):
    return parts(spark, sf).preview()


@query(
    "discovery_run",
    f"""
SELECT p_partkey, p_name, p_retailprice AS score, 'matched' AS match_status FROM part WHERE {_MATCH}
ORDER BY p_retailprice DESC, p_partkey LIMIT 25""",
)
def discovery_run(spark, sf):
    return parts(spark, sf).run().select("p_partkey", "p_name", "score", "match_status")


@query(
    "discovery_pool",
    f"""
SELECT 'base' AS generator, p_partkey FROM part WHERE {_SIZE}
UNION ALL SELECT 'core', p_partkey FROM part WHERE ({_SIZE}) OR {_TYPE}
UNION ALL SELECT 'pro', p_partkey FROM part""",
)
def discovery_pool(spark, sf):
    out = None
    for generator in D.GENERATORS:
        pool = parts(spark, sf, generator).pool().select(F.lit(generator).alias("generator"), "p_partkey")
        out = pool if out is None else out.unionByName(pool)
    return out


_HOST = "lower(regexp_extract(url, '^https?://([^/:?#]+)', 1))"


@query(
    "discovery_exclude",
    f"""
SELECT page_id, split_part({_HOST}, '.', 1) AS name FROM pages
WHERE {_HOST} NOT IN (SELECT {_HOST} FROM pages WHERE url LIKE '%cheap-pills%') AND split_part({_HOST}, '.', 1) <> 'm'""",
)
def discovery_exclude(spark, sf):
    from tablerich.operators.search import host

    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.split_part(host(F.col("url")), F.lit("."), F.lit(1)).alias("name")
    )
    null = F.lit(None).cast("string")
    spam = pages.filter(F.col("url").contains("cheap-pills")).select(null.alias("name"), "url")
    mobile = pages.filter(F.col("name") == "m").select(F.lit(" M. ").alias("name"), null.alias("url"))
    return D.exclude_entities(pages, spam.unionByName(mobile), "name", "url").select("page_id", "name")


@query(
    "discovery_metrics",
    f"SELECT p_brand, count(*) AS generated, count(*) FILTER ({_MATCH}) AS matched FROM part GROUP BY 1",
)
def discovery_metrics(spark, sf):
    return D.metrics(parts(spark, sf).candidates(), ["p_brand"])


@query("discovery_matched", f"SELECT p_partkey, p_name, p_brand FROM part WHERE {_MATCH}")
def discovery_matched(spark, sf):
    return D.matched(parts(spark, sf).candidates()).select("p_partkey", "p_name", "p_brand")


@query(
    "discovery_extend",
    f"""
SELECT p_partkey, CAST(rank AS INTEGER) AS rank FROM (SELECT p_partkey, row_number() OVER (
  ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part WHERE {_MATCH}) WHERE rank > 25 AND rank <= 50""",
)
def discovery_extend(spark, sf):
    return parts(spark, sf).extend(25).select("p_partkey", "rank")


@query("discovery_sorted", f"SELECT p_name, p_partkey FROM part WHERE {_MATCH} ORDER BY p_name, p_partkey")
def discovery_sorted(spark, sf):
    return D.matched(parts(spark, sf).candidates()).select("p_name", "p_partkey").orderBy("p_name", "p_partkey")


@query(
    "discovery_unpack",
    f"""
SELECT p_partkey, 'size_ok' AS field, CAST(p_size AS VARCHAR) AS value FROM part WHERE {_MATCH}
UNION ALL SELECT p_partkey, 'economy', 'true' FROM part WHERE {_MATCH}""",
)
def discovery_unpack(spark, sf):
    rows = D.matched(parts(spark, sf).candidates())
    return rows.select("p_partkey", F.explode(D.output_values(F.col("output"))).alias("field", "value"))


def _two_kinds(spark, sf):
    """Candidates of two tables with different columns and output fields."""
    first = parts(spark, sf).candidates().select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("details"),
        "output",
        "match_status",
    )
    rich = D.Discovery(
        "rich suppliers", "suppliers", table(spark, sf, "supplier"), "s_suppkey",
        [D.Condition("rich", "balance over 5000", F.col("s_acctbal") > 5000)], F.col("s_acctbal"),
    )
    second = rich.candidates().select(
        F.col("s_suppkey").alias("id"), F.array("s_name", F.col("s_nationkey").cast("string")).alias("tags"), "output", "match_status"
    )
    return first, second


@query(
    "discovery_flatten",
    f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, '{{"brand":"' || p_brand || '","size":' || p_size || '}}' AS details,
       CAST(p_size AS VARCHAR) AS size_ok, 'true' AS economy, CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS VARCHAR) AS rich
FROM part WHERE {_MATCH}
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), NULL, NULL, NULL, NULL, '["' || s_name || '","' || s_nationkey || '"]', 'true'
FROM supplier WHERE s_acctbal > 5000""",
)
def discovery_flatten(spark, sf):
    return D.flatten_union(_two_kinds(spark, sf), "id")


@query(
    "discovery_table",
    f"""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS size_ok, 'true' AS economy
FROM part WHERE {_MATCH} ORDER BY p_retailprice DESC, part.p_partkey LIMIT 25""",
)
def discovery_table(spark, sf):
    found = parts(spark, sf).run().select("p_partkey", "p_name", "output", "match_status")
    return D.flatten(found, "p_partkey", fields=["size_ok", "economy"])


_JSON = f"""
WITH r AS (SELECT p_brand, p_partkey, p_name, p_size, row_number() OVER (
             PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part WHERE {_MATCH})"""


def _json(spark, sf):
    candidates = parts(spark, sf).candidates().select(
        "p_brand", "p_partkey", "p_name", "p_retailprice", "output", "match_status"
    )
    order = [F.desc("p_retailprice"), F.asc("p_partkey")]
    return D.as_json(candidates, "p_brand", order)


@query(
    "discovery_json",
    _JSON
    + """
SELECT b.p_brand, CAST(count(r.p_partkey) AS INTEGER) AS n,
  coalesce(string_agg(p_name || '/' || r.p_partkey || '/' || p_size, ',' ORDER BY rank), '') AS names
FROM (SELECT DISTINCT p_brand FROM part) b LEFT JOIN r ON r.p_brand = b.p_brand AND rank <= 10 GROUP BY 1""",
)
def discovery_json(spark, sf):
    arrays = _json(spark, sf)
    rows = F.from_json("candidates", "array<struct<p_name:string,p_partkey:string,size_ok:string>>")
    text = F.transform(rows, lambda x: F.concat_ws("/", x["p_name"], x["p_partkey"], x["size_ok"]))
    return arrays.select("p_brand", F.size(rows).alias("n"), F.array_join(text, ",").alias("names"))


@query(
    "discovery_unnest",
    _JSON
    + """
SELECT p_brand, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS size_ok, 'true' AS economy
FROM r WHERE rank <= 10""",
)
def discovery_unnest(spark, sf):
    return D.from_json_rows(
        _json(spark, sf), "p_brand", "candidates", ["p_partkey", "p_name", "size_ok", "economy"]
    )


_RETURNED = """SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers,
  sum(l_quantity) FILTER (l_quantity >= 49 AND l_returnflag = 'R') AS quantity FROM lineitem GROUP BY 1"""


def _enriched(spark, sf):
    known = (
        table(spark, sf, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.countDistinct("l_suppkey").alias("suppliers"),
            F.sum(F.when((F.col("l_quantity") >= 49) & (F.col("l_returnflag") == "R"), F.col("l_quantity")))
            .cast("bigint").alias("quantity"),
        )
        .hint("rebalance")
    )
    resolver = TableResolver(
        known, {"part": "l_partkey"}, {"suppliers": "suppliers", "returned": "quantity"}, unique=True
    )
    return D.enrich_matched(parts(spark, sf).candidates(), {"part": "p_partkey"}, ["Suppliers", "Returned (pieces)"], resolver)


@query(
    "discovery_enrich",
    f"""
SELECT p_partkey, CASE WHEN {_MATCH} THEN 'matched' ELSE 'unmatched' END AS match_status,
       CASE WHEN {_MATCH} THEN CAST(suppliers AS VARCHAR) END AS suppliers,
       CASE WHEN {_MATCH} THEN CAST(CAST(quantity AS BIGINT) AS VARCHAR) END AS returned
FROM part LEFT JOIN ({_RETURNED}) ON p_partkey = l_partkey""",
)
def discovery_enrich(spark, sf):
    values = D.output_values(F.col("output"))
    return _enriched(spark, sf).select(
        "p_partkey", "match_status", values["suppliers"].alias("suppliers"), values["returned"].alias("returned")
    )


@query(
    "discovery_coverage",
    f"""
SELECT count(*) AS total, count(quantity) AS enriched, count(*) = count(quantity) AS done
FROM part LEFT JOIN ({_RETURNED}) ON p_partkey = l_partkey WHERE {_MATCH}""",
)
def discovery_coverage(spark, sf):
    return D.coverage(_enriched(spark, sf), ["size_ok", "suppliers", "returned"])


_COMPANY_QUERY, _PEOPLE_QUERY = "small red widget economy", "household machinery"


def _top(entity_type: str, ctes: str) -> str:
    return (
        f"SELECT '{entity_type}' AS entity_type, id, score, CAST(rank AS INTEGER) AS rank FROM (WITH {ctes} "
        "SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= 50"
    )


@query(
    "entity_search",
    _top("companies", bm25_sql("part", "p_partkey", "p_name || ' ' || p_type", [_COMPANY_QUERY]))
    + " UNION ALL "
    + _top("people", bm25_sql("customer", "c_custkey", "c_name || ' ' || c_mktsegment", [_PEOPLE_QUERY])),
)
def entity_search(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("description")
    )
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.concat_ws(" ", "c_name", "c_mktsegment").alias("description")
    )
    entities = {"companies": Corpus(part, "id", "description"), "people": Corpus(customer, "id", "description")}
    found = lambda kind, text: D.entity_search(entities, kind, text, 50).select(
        F.lit(kind).alias("entity_type"), "id", "score", "rank"
    )
    return found("companies", _COMPANY_QUERY).unionByName(found("people", _PEOPLE_QUERY))
