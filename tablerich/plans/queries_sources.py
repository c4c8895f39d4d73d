"""Queries: sources, names, schemas and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablerich.operators import enrich as E
from tablerich.operators import extract as X
from tablerich.operators import inputs as I
from tablerich.operators import naming as N
from tablerich.operators import report as R
from tablerich.operators.resolvers import BASIS_TYPE
from tablerich.plans.catalog import query, table
from tablerich.sources import readers

_INLINE = """CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN '[]' WHEN 'view' THEN '[' || props
  WHEN 'click' THEN '["a"]' ELSE '[' || props || ',{"extra":1,"k":' || user_id || '}]' END"""


@query(
    "src_inline_rows",
    f"""
WITH x AS (SELECT event_id, {_INLINE} AS doc FROM events),
c AS (SELECT event_id, doc,
        CASE WHEN NOT json_valid(doc) THEN 'The text is not JSON'
             WHEN json_type(doc) <> 'ARRAY' THEN 'A JSON array is expected'
             WHEN json_array_length(doc) = 0 THEN 'The array is empty'
             WHEN json_type(doc, '$[0]') <> 'OBJECT' THEN 'The array must hold objects' END AS error
      FROM x),
g AS (SELECT event_id, doc, unnest(range(1, CAST(json_array_length(doc) AS BIGINT) + 1)) AS ordinal
      FROM c WHERE error IS NULL),
k AS (SELECT *, list_filter(json_keys(doc, '$[' || (ordinal - 1) || ']'), lambda f: NOT list_contains(json_keys(doc, '$[0]'), f))
        AS unknown FROM g)
SELECT event_id, CAST(ordinal AS INTEGER) AS ordinal,
       CASE WHEN len(unknown) = 0 THEN json_extract_string(doc, '$[' || (ordinal - 1) || '].k') END AS k,
       CASE WHEN len(unknown) = 0 THEN CAST(len(json_keys(doc, '$[' || (ordinal - 1) || ']')) AS INTEGER) END AS n_fields,
       CASE WHEN len(unknown) > 0 THEN 'Unknown fields: ' || array_to_string(unknown, ', ') END AS error
FROM k
UNION ALL
SELECT event_id, NULL, NULL, NULL, error FROM c WHERE error IS NOT NULL""",
)
def src_inline_rows(spark, sf):
    texts = table(spark, sf, "events").select("event_id", F.expr(_INLINE).alias("doc"))
    rows = I.parse_inline_rows(texts, "doc", "event_id")
    return rows.select(
        "event_id", "ordinal", F.col("row")["k"].alias("k"),
        F.when(F.col("row").isNotNull(), F.size("row")).alias("n_fields"), "error",
    )


@query("src_table", "SELECT * FROM customer")
def src_table(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    return readers.read_table(spark, "customer_source")


@query("src_query", "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0")
def src_query(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("customer_source")
    return readers.read_source(
        spark, "SELECT c_custkey, c_name, c_mktsegment FROM customer_source WHERE c_acctbal > 0", []
    )


@query(
    "src_columns",
    """
SELECT 1 AS ordinal, 'o_orderkey' AS name, 'bigint' AS type, count(o_orderkey) AS filled FROM orders
UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders""",
)
def src_columns(spark, sf):
    return readers.source_columns(table(spark, sf, "orders"))


def name_sql(c: str) -> str:
    """SQL for the name rule over expression ``c``."""
    base = rf"regexp_replace(regexp_replace({c}, '(?s)[(\[{{].*$', ''), '^\s+|\s+$', '', 'g')"
    cleaned = rf"regexp_replace(regexp_replace(lower({base}), '[ -]', '_', 'g'), '[^\p{{L}}\p{{N}}_]', '', 'g')"
    return (
        f"(CASE WHEN {cleaned} = '' THEN 'column' "
        rf"WHEN regexp_matches({cleaned}, '^\p{{L}}') THEN {cleaned} ELSE 'col_' || {cleaned} END)"
    )


@query(
    "output_names",
    f"""
SELECT 'document' AS origin, doc_id AS id, {name_sql('text')} AS name FROM documents
UNION ALL
SELECT 'part', p_partkey, {name_sql("p_size || ' ' || p_name || ' (' || p_type || ')'")} FROM part""",
)
def output_names(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.col("text").alias("description")
    )
    described = F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit(" ("), "p_type", F.lit(")"))
    parts = table(spark, sf, "part").select(F.lit("part"), F.col("p_partkey"), described)
    return docs.union(parts).select("origin", "id", N.name_of(F.col("description")).alias("name"))


@query(
    "output_schema_json",
    f"""
WITH d AS (SELECT p_partkey, {name_sql("p_name || ' (' || p_type || ')'")} AS n1,
                  {name_sql("p_brand || ' size ' || p_size")} AS n2,
                  p_brand || ' size ' || p_size AS d2, replace(p_name, ' ', '-') || ' [other]' AS d3 FROM part)
SELECT p_partkey,
  '{{"type":"object","properties":{{"' || n1 || '":{{"type":"string","description":"' || d3 || '"}},"' || n2
  || '":{{"type":"string","description":"' || d2 || '"}}}},"required":["' || n1 || '","' || n2 || '"]}}' AS schema_json
FROM d""",
)
def output_schema_json(spark, sf):
    descriptions = F.array(
        F.concat("p_name", F.lit(" ("), "p_type", F.lit(")")),
        F.concat("p_brand", F.lit(" size "), F.col("p_size").cast("string")),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" [other]")),
    )
    return table(spark, sf, "part").select("p_partkey", N.schema_json(descriptions).alias("schema_json"))


@query(
    "input_projection",
    """
SELECT s_suppkey, '{"company_name":"' || s_name || '","country":"' || s_nationkey || '"'
  || CASE WHEN s_acctbal < 0 THEN '' ELSE ',"balance":"' || CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '"' END
  || '}' AS input, CASE WHEN s_acctbal < 0 THEN 2 ELSE 3 END AS n_inputs
FROM supplier""",
)
def input_projection(spark, sf):
    balance = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("decimal(18,2)"))
    inputs = {"company_name": "s_name", "country": "s_nationkey", "balance": balance}
    return table(spark, sf, "supplier").select(
        "s_suppkey", I.input_json(inputs).alias("input"), F.size(I.input_map(inputs)).alias("n_inputs")
    )


@query(
    "parse_content",
    """
WITH c AS (SELECT 'event' AS origin, event_id AS id, props AS content FROM events
           UNION ALL SELECT 'document', doc_id, text FROM documents)
SELECT origin, id, CASE WHEN json_valid(content) AND json_type(content) = 'OBJECT' THEN CAST(json(content) AS VARCHAR)
                        ELSE CAST(to_json({'result': content}) AS VARCHAR) END AS parsed FROM c""",
)
def parse_content(spark, sf):
    events = table(spark, sf, "events").select(
        F.lit("event").alias("origin"), F.col("event_id").alias("id"), F.col("props").alias("content")
    )
    docs = table(spark, sf, "documents").select("doc_id", "text").select(F.lit("document"), "doc_id", "text")
    return events.union(docs).select("origin", "id", E.parse_content(F.col("content")).alias("parsed"))


@query(
    "unpack_json",
    "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def unpack_json(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "props")
    return E.unpack_json(events, "props", "k bigint")


_ANSWER = """CASE WHEN event_type = 'error' THEN '{"error":"code ' || user_id || '"}' ELSE props END"""


@query(
    "error_or_value",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'Error: code ' || user_id "
    "ELSE json_extract_string(props, '$.k') END AS value FROM events",
)
def error_or_value(spark, sf):
    answered = table(spark, sf, "events").withColumn("answer", F.expr(_ANSWER))
    return answered.select("event_id", E.error_or_value(F.col("answer"), "$.k").alias("value"))


@query(
    "successful_rows",
    "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events "
    "WHERE event_type <> 'error'",
)
def successful_rows(spark, sf):
    answered = table(spark, sf, "events").select("event_id", "user_id", F.expr(_ANSWER).alias("answer"))
    unpacked = E.unpack_json(answered, "answer", "k string")
    return unpacked.filter(F.col("k").isNotNull()).withColumn("k", N.cast_declared(F.col("k"), "int"))


@query(
    "typed_outputs",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS as_int, round(value, 2) AS as_float,
       event_type = 'error' AS as_bool, CAST(ts AS DATE) AS as_date, CAST(date_trunc('second', ts) AS TIMESTAMP) AS as_datetime,
       CAST(NULL AS BIGINT) AS bad_int, CAST(json_extract_string(props, '$.k') AS BIGINT) + user_id AS list_sum,
       event_type AS as_str
FROM events""",
)
def typed_outputs(spark, sf):
    k = F.get_json_object("props", "$.k")
    as_text = table(spark, sf, "events").select(
        "event_id",
        k.alias("as_int"),
        F.round("value", 2).cast("string").alias("as_float"),
        F.when(F.col("event_type") == "error", "true").otherwise("false").alias("as_bool"),
        F.date_format("ts", "yyyy-MM-dd").alias("as_date"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("as_datetime"),
        F.col("event_type").alias("bad_int"),
        F.concat(F.lit("["), k, F.lit(","), F.col("user_id").cast("string"), F.lit("]")).alias("items"),
        F.col("event_type").alias("as_str"),
    )
    typed = lambda c, t: N.cast_declared(F.col(c), t)
    return as_text.select(
        "event_id",
        typed("as_int", "int").alias("as_int"),
        typed("as_float", "float | None").alias("as_float"),
        typed("as_bool", "bool").alias("as_bool"),
        typed("as_date", "date").alias("as_date"),
        typed("as_datetime", "datetime").cast("timestamp_ntz").alias("as_datetime"),
        typed("bad_int", "int | None").alias("bad_int"),
        F.aggregate(typed("items", "list[int]"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("list_sum"),
        typed("as_str", "str").alias("as_str"),
    )


_JSON_TYPE = """CASE p_type WHEN 'ECONOMY' THEN 'integer' WHEN 'STANDARD' THEN 'number' WHEN 'SMALL' THEN 'boolean'
  WHEN 'MEDIUM' THEN 'array' WHEN 'LARGE' THEN 'object' ELSE 'string' END"""


@query(
    "schema_columns",
    """
SELECT p_partkey, 0 AS pos, replace(p_name, ' ', '_') AS name, p_brand AS description,
       CASE p_type WHEN 'ECONOMY' THEN 'int' WHEN 'STANDARD' THEN 'float' WHEN 'SMALL' THEN 'bool'
         WHEN 'MEDIUM' THEN 'list[str]' ELSE 'str' END AS type FROM part
UNION ALL SELECT p_partkey, 1, 'size', '', 'int' FROM part""",
)
def schema_columns(spark, sf):
    text = F.expr(
        """concat('{"type":"object","properties":{"', replace(p_name, ' ', '_'), '":{"type":"', """
        + _JSON_TYPE
        + """, '","description":"', p_brand, '"},"size":{"type":"integer"}}}')"""
    )
    found = table(spark, sf, "part").select("p_partkey", F.posexplode(N.schema_entries(text)).alias("pos", "c"))
    return found.select("p_partkey", "pos", "c.*")


@query(
    "domain_list",
    r"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text || ',' || source, ','),
             lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS items FROM documents)
SELECT doc_id, CAST(len(items) AS INTEGER) AS n_items, array_to_string(items, '|') AS items FROM p""",
)
def domain_list(spark, sf):
    items = I.comma_list(F.array("text", "source"))
    listed = table(spark, sf, "documents").select("doc_id", "text", "source").select("doc_id", items.alias("items"))
    return listed.select("doc_id", F.size("items").alias("n_items"), F.array_join("items", "|").alias("items"))


def _raw_basis():
    """Raw entries: a full one, an empty one, and one in the fallback shape."""
    null = F.lit(None).cast("string")
    texts = F.lit(None).cast("array<string>")
    cited = F.lit(None).cast("array<struct<url:string,excerpts:array<string>>>")

    def entry(field=null, citations=cited, reasoning=null, confidence=null, url=null, title=null, excerpts=texts):
        return F.struct(
            field.alias("field"), citations.alias("citations"), reasoning.alias("reasoning"),
            confidence.alias("confidence"), url.alias("url"), title.alias("title"), excerpts.alias("excerpts"),
        )

    page = F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string"))
    band = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") < 5000, "medium").otherwise("high")
    return F.array(
        entry(
            field=F.lit("country"),
            citations=F.array(F.struct(page.alias("url"), F.array("c_mktsegment").alias("excerpts"))),
            reasoning=F.lit(""), confidence=band, title=F.lit("unused"),
        ),
        entry(field=F.lit("")),
        entry(url=page, title=F.col("c_name"), excerpts=F.array().cast("array<string>")),
    )


@query(
    "basis_normalise",
    """
SELECT c_custkey, '[{"field":"country","citations":[{"url":"nation:' || c_nationkey || '","excerpts":["' || c_mktsegment
  || '"]}]' || CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 5000 THEN ',"confidence":"medium"'
                    ELSE ',"confidence":"high"' END
  || '},{"url":"nation:' || c_nationkey || '","title":"' || c_name || '"}]' AS basis
FROM customer""",
)
def basis_normalise(spark, sf):
    customers = table(spark, sf, "customer").withColumn("raw", _raw_basis().cast(BASIS_TYPE))
    return customers.select("c_custkey", F.to_json(E.normalise_basis(F.col("raw"))).alias("basis"))


@query(
    "render_markdown",
    """
SELECT s_suppkey, '# Company Name' || chr(10) || chr(10) || s_name || chr(10) || chr(10)
  || '# Key Facts' || chr(10) || chr(10) || '- nation ' || s_nationkey || chr(10) || '- region ' || n_regionkey || chr(10)
  || chr(10) || '# Region Details' || chr(10) || chr(10) || '## Country Name' || chr(10) || chr(10) || n_name || chr(10)
  || chr(10) || '## Rank' || chr(10) || chr(10) || s_nationkey || chr(10) || chr(10) AS markdown
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def render_markdown(spark, sf):
    joined = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    content = F.to_json(
        F.struct(
            F.col("s_name").alias("company_name"),
            F.array(
                F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")),
                F.concat(F.lit("region "), F.col("n_regionkey").cast("string")),
            ).alias("key_facts"),
            F.struct(F.col("n_name").alias("country_name"), F.col("s_nationkey").alias("rank")).alias("region_details"),
        )
    )
    return joined.select("s_suppkey", R.markdown(content).alias("markdown"))


_REPORT = "concat('# ', source, ' report', chr(10), chr(10), replace(text, chr(10), concat(chr(10), '## Part', chr(10))))"


@query(
    "exec_summary",
    rf"""
WITH r AS (SELECT doc_id, {_REPORT} AS report FROM documents),
lead AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(report, '^\s+|\s+$', '', 'g'),
           '(?ms)^##\s.*', ''), '^\s+|\s+$', '', 'g') AS t FROM r),
body AS (SELECT doc_id, regexp_replace(regexp_replace(t, '^# [^\n]*', ''), '^\s+|\s+$', '', 'g') AS t FROM lead)
SELECT doc_id, CASE WHEN length(t) > 20 THEN t END AS summary FROM body""",
)
def exec_summary(spark, sf):
    reports = table(spark, sf, "documents").select("doc_id", "text", "source").select("doc_id", F.expr(_REPORT).alias("report"))
    return reports.select("doc_id", R.executive_summary(F.col("report")).alias("summary"))


@query(
    "report_kind",
    """
SELECT conv_id, turn,
       CASE role WHEN 'assistant' THEN true WHEN 'user' THEN length(text) > 0 ELSE turn > 3 END AS is_text
FROM conversations""",
)
def report_kind(spark, sf):
    kind = F.when(F.col("role") == "assistant", "text").when(F.col("role") == "system", "json")
    requested = F.when((F.col("role") == "system") & (F.col("turn") > 3), "text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", R.is_text_report(kind, requested, F.col("text")).alias("is_text")
    )


@query(
    "truncate_excerpts",
    r"""
WITH p AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents)
SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS short,
       CASE WHEN length(text) > 1000 THEN left(text, 1000) || '...' ELSE text END AS content,
       array_to_string(list_transform(x[1:3],
         lambda t: CASE WHEN length(t) > 300 THEN left(t, 300) || '...' ELSE t END), '|') AS excerpts,
       left(text, 50) AS summary
FROM p""",
)
def truncate_excerpts(spark, sf):
    lines = F.slice(F.split("text", "\n"), 1, 3)
    return table(spark, sf, "documents").select(
        "doc_id",
        X.truncate(F.col("text"), 200).alias("short"),
        X.truncate(F.col("text"), 1000).alias("content"),
        F.array_join(F.transform(lines, lambda t: X.truncate(t, 300)), "|").alias("excerpts"),
        F.left("text", F.lit(50)).alias("summary"),
    )
