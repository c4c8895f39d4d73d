"""Queries: SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.functions import sql as S
from tablerich.plans.catalog import query, table


def name_facts(rows, names):
    """Upper-case name and its length, under the first two names asked for."""
    return [dict(zip(names, [r["name"].upper(), str(len(r["name"]))])) for r in rows]


def name_codes(rows, names):
    """Lower-case name and its last three characters."""
    return [dict(zip(names, [r["name"].lower(), r["name"][-3:]])) for r in rows]


PROCESSORS = {"lite-fast": name_facts, "core": name_codes}

_UPPER = """'{"upper_name":"' || upper(c_name) || '","name_length":"' || length(c_name) || '"}'"""
_LOWER = """'{"upper_name":"' || lower(c_name) || '","name_length":"' || right(c_name, 3) || '"}'"""


@query(
    "udf_enrich",
    f"""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL
  WHEN c_mktsegment = 'BUILDING' THEN '{{"upper_name":"' || upper(c_name) || '"}}' ELSE {_UPPER} END AS answer
FROM customer""",
)
def udf_enrich(spark, sf):
    S.register(spark, PROCESSORS, prefix="rich_")
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    return spark.sql(
        """
        SELECT c_custkey,
               rich_enrich(CASE WHEN c_acctbal >= 0 THEN map('name', c_name) END,
                           CASE WHEN c_mktsegment = 'BUILDING' THEN array('Upper name')
                                ELSE array('Upper name', 'Name length (characters)') END) AS answer
        FROM customer_source"""
    )


@query(
    "udf_enrich_with_processor",
    f"""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN {_LOWER}
  WHEN 'MACHINERY' THEN '{{"error":"unknown processor: huge"}}' ELSE {_UPPER} END AS answer
FROM customer""",
)
def udf_enrich_with_processor(spark, sf):
    S.register(spark, PROCESSORS, prefix="rich_")
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    return spark.sql(
        """
        SELECT c_custkey,
               rich_enrich_with_processor(map('name', c_name), array('Upper name', 'Name length'),
                 CASE c_mktsegment WHEN 'BUILDING' THEN 'core' WHEN 'MACHINERY' THEN 'huge' ELSE ' ' END) AS answer
        FROM customer_source"""
    )


@query(
    "udf_enrich_json",
    f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN '{{"error":"output columns: a JSON array is expected"}}'
  WHEN c_mktsegment = 'HOUSEHOLD' THEN '{{"error":"output columns: not JSON"}}'
  WHEN c_acctbal < 0 THEN '{{"error":"input: not JSON"}}'
  WHEN c_acctbal < 1000 THEN '{{"error":"input: a JSON object is expected"}}'
  WHEN c_mktsegment = 'AUTOMOBILE' THEN '{{"error":"output columns: every one needs a description"}}'
  ELSE {_UPPER} END AS answer
FROM customer""",
)
def udf_enrich_json(spark, sf):
    S.register(spark, PROCESSORS, prefix="rich_")
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    return spark.sql(
        """
        SELECT c_custkey,
               rich_enrich_json(CASE WHEN c_acctbal < 0 THEN '{bad' WHEN c_acctbal < 500 THEN 'null'
                   WHEN c_acctbal < 1000 THEN '5' ELSE to_json(struct(c_name AS name)) END,
                 CASE c_mktsegment WHEN 'MACHINERY' THEN '{"a":1}' WHEN 'HOUSEHOLD' THEN 'Upper name'
                   WHEN 'AUTOMOBILE' THEN '[1,{}]'
                   ELSE '["Upper name","Name length"]' END) AS answer
        FROM customer_source"""
    )


@query(
    "udf_enrich_entity",
    f"SELECT s_suppkey, {_UPPER.replace('c_name', 's_name')} AS answer FROM supplier",
)
def udf_enrich_entity(spark, sf):
    S.register(spark, PROCESSORS, prefix="rich_")
    table(spark, sf, "supplier").createOrReplaceTempView("supplier_source")
    return spark.sql(
        """
        SELECT s_suppkey, rich_enrich_entity(s_name, concat('nation', s_nationkey, '.example.com'),
                                             array('Upper name', 'Name length')) AS answer
        FROM supplier_source"""
    )


@query(
    "udtf_enrich",
    """
SELECT '{"name":"' || c_name || '"}' AS input,
       '{"upper_name":"' || upper(c_name) || '","name_length":"' || length(c_name) || '"}' AS enriched
FROM customer""",
)
def udtf_enrich(spark, sf):
    calls = table(spark, sf, "customer").select(
        "c_nationkey",
        "c_custkey",
        F.to_json(F.struct(F.col("c_name").alias("name"))).alias("input_json"),
        F.array(F.lit("Upper name"), F.lit("Name length")).alias("output_columns"),
    )
    return S.call_by_group(calls, ["c_nationkey"], ["c_custkey"], S.table_function(name_facts))
