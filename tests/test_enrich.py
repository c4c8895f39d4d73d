import json

import pytest
from pyspark.sql import functions as F

from tablerich.operators import enrich as E
from tablerich.operators.naming import OutputColumn
from tablerich.operators.resolvers import BASIS_TYPE, CallableResolver, ExprResolver, TableResolver, call_in_chunks


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame(
        [(1, "Acme", "a.com"), (2, "Beta", None), (3, None, None), (4, "Zed", "z.com")], "id int, name string, site string"
    )


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("Acme", "Ann", "1999"), ("Beta", "Bob", "x")], "k string, ceo string, year string")


def upper(rows, names):
    return [{names[0]: r["name"].upper()} if "name" in r else {"error": "no name"} for r in rows]


def test_chunks_of_a_call():
    sizes = []

    def fn(rows, names):
        sizes.append(len(rows))
        return [{"n": r["i"]} for r in rows]

    out = call_in_chunks(fn, [{"i": i} for i in range(2500)], ["n"])
    assert sizes == [1000, 1000, 500]
    assert [r["n"] for r in out] == list(range(2500))


def test_failed_call_marks_its_chunk_and_short_answers_have_no_result():
    def fn(rows, names):
        if rows[0]["i"] == 1000:
            raise RuntimeError("down")
        return [{"n": 1}] * (len(rows) - 1)

    out = call_in_chunks(fn, [{"i": i} for i in range(2000)], ["n"])
    assert out[998] == {"n": 1} and out[999] == {"error": "No result"}
    assert out[1000:] == [{"error": "down"}] * 1000


def test_table_resolver(companies, known):
    resolver = TableResolver(known, {"company": "k"}, {"ceo_name": "ceo", "founding_year": "year"})
    done = E.enrich(companies, {"company": "name"}, ["CEO name", "Founding year (YYYY)", "Unknown"], resolver)
    rows = {r.id: r for r in done.table().collect()}
    assert len(rows) == 4
    assert (rows[1].ceo_name, rows[1].founding_year, rows[1].unknown) == ("Ann", "1999", None)
    assert rows[3].ceo_name is None and rows[4].ceo_name is None
    assert {r.id: r.error for r in done.errors().collect()} == {3: "No result", 4: "No result"}
    assert done.metrics().first().asDict() == {"total_count": 4, "success_count": 2, "error_count": 2}
    by_id = {r.id: r for r in done.results().collect()}
    assert by_id[2].status == "completed" and json.loads(by_id[2].answer)["ceo_name"] == "Bob"
    assert by_id[4].status == "failed" and by_id[4].answer is None


def test_repeated_knowledge_never_multiplies_rows(companies, known):
    resolver = TableResolver(known.union(known), {"company": "k"}, {"ceo_name": "ceo"})
    assert E.enrich(companies, {"company": "name"}, ["CEO name"], resolver).table().count() == 4


def test_output_replaces_source_column_and_keep_inputs(companies, known):
    resolver = TableResolver(known, {"company": "k"}, {"site": "ceo"}, unique=True)
    done = E.enrich(companies, {"company": "name"}, ["Site"], resolver)
    assert done.table().columns == ["id", "name", "site"]
    assert {r.id: r.site for r in done.table().collect()}[1] == "Ann"
    assert done.table(keep="inputs").columns == ["name", "site"]


def test_callable_resolver(companies):
    done = E.enrich(companies, {"name": "name"}, ["Shout"], CallableResolver(upper))
    assert {r.id: r.shout for r in done.table().collect()} == {1: "ACME", 2: "BETA", 3: None, 4: "ZED"}
    assert {r.id: r.error for r in done.errors().collect()} == {3: "no name"}
    once = E.enrich(companies.union(companies), {"name": "name"}, ["Shout"], CallableResolver(upper, dedupe=True))
    assert once.table().count() == 8


def test_calls_can_be_dealt_out(companies):
    done = E.enrich(companies, {"name": "name"}, ["Shout"], CallableResolver(upper, partitions=3))
    assert done.table().rdd.getNumPartitions() == 3 and done.table().count() == 4


def test_callable_basis_and_nested_values(companies):
    def fn(rows, names):
        return [
            {"facts": {"a": [1]}, "basis": [{"field": "facts", "citations": [{"url": "u", "excerpts": ["x"]}]}]}
            for _ in rows
        ]

    row = E.enrich(companies, {"name": "name"}, ["Facts"], CallableResolver(fn)).table(include_basis=True).first()
    assert json.loads(row.facts) == {"a": [1]}
    assert row._basis[0].citations[0].url == "u"


def test_expr_resolver_and_json_column(companies):
    resolver = ExprResolver(
        {"length": F.length("name")}, error=F.when(F.col("name").isNull(), "empty")
    )
    done = E.enrich(companies, {"name": "name"}, [OutputColumn("length", "letters", "int")], resolver)
    assert done.table().schema["length"].dataType.simpleString() == "bigint"
    texts = {r.id: json.loads(r.enriched_data) for r in done.json_column().collect()}
    assert texts[1] == {"length": "4"} and texts[3] == {"error": "empty"}


def test_empty_source_keeps_schema(companies, known):
    resolver = TableResolver(known, {"company": "k"}, {"ceo_name": "ceo"})
    table = E.enrich(companies.filter("id > 100"), {"company": "name"}, ["CEO name"], resolver).table()
    assert table.columns == ["id", "name", "site", "ceo_name"] and table.count() == 0


def test_single_record(spark, known):
    resolver = TableResolver(known, {"company": "k"}, {"ceo_name": "ceo"})
    assert E.enrich_one(spark, {"company": "Beta"}, ["CEO name"], resolver).table().first().ceo_name == "Bob"


def test_observation(companies, known):
    resolver = TableResolver(known, {"company": "k"}, {"ceo_name": "ceo"}, unique=True)
    table, observation = E.enrich(companies, {"company": "name"}, ["CEO name"], resolver).observed()
    table.write.format("noop").mode("overwrite").save()
    assert observation.get == {"total_count": 4, "success_count": 2, "error_count": 2}


def test_missing_column_raises_before_running(companies, known):
    with pytest.raises(ValueError, match="nope"):
        E.enrich(companies, {"company": "nope"}, ["CEO name"], TableResolver(known, {"company": "k"}, {}))


def test_typed_job_drops_and_explains(companies, known):
    resolver = TableResolver(known, {"company": "k"}, {"ceo": "ceo", "year": "year"})
    outputs = [OutputColumn("ceo", "name"), OutputColumn("year", "founded", "int")]
    good, bad = E.typed_job(companies, {"company": "name"}, outputs, resolver)
    row = good.first()
    assert (row.company, row.ceo, row.year) == ("Acme", "Ann", 1999)
    assert row.batch_id and row.insertion_timestamp
    assert good.count() == 1
    assert sorted((r.company or "", r.error) for r in bad.collect()) == [
        ("", "No result"), ("Beta", "missing or invalid: year"), ("Zed", "No result"),
    ]
    optional = [outputs[0], OutputColumn("year", "founded", "int | None")]
    assert E.typed_job(companies, {"company": "name"}, optional, resolver)[0].count() == 2


def test_partitioned_calls_see_bounded_parts_of_a_hot_group(spark):
    df = spark.range(3000).selectExpr("id", "IF(id < 2500, 'hot', concat('g', id % 5)) AS g", "concat('n', id) AS name")

    def fn(rows, names):
        assert len(rows) <= 1000
        return [{"size": r["group_rows"], "seen": len(rows)} for r in rows]

    got = [json.loads(r.enriched) for r in E.enrich_partitioned(df, ["g"], ["id"], {"name": "name"}, ["Size"], fn).collect()]
    assert len(got) == 3000
    assert sum(g["size"] == "2500" for g in got) == 2500 and sum(g["size"] == "100" for g in got) == 500
    splits = E.split_groups(df, ["g"], ["id"]).groupBy("g", "split").count()
    assert splits.filter("g = 'hot'").count() == 3


def test_content_and_errors(spark):
    texts = ['{"a": 1}', "plain", "[1]", '"s"', "5", "{bad"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [json.loads(r[0]) for r in df.select(E.parse_content(F.col("t"))).collect()]
    assert got == [{"a": 1}] + [{"result": t} for t in texts[1:]]
    answers = spark.createDataFrame([('{"error":"x"}',), ('{"v":"1"}',)], "t string")
    assert [r[0] for r in answers.select(E.error_or_value(F.col("t"), "$.v")).collect()] == ["Error: x", "1"]


def test_basis_shapes(spark):
    raw = """[{"field":"ceo","citations":[{"url":"u"}],"reasoning":"","confidence":"high","title":"t"},
              {"url":"w","title":"t","excerpts":["e"]},{"field":""},{}]"""
    df = spark.range(1).select(F.from_json(F.lit(raw), BASIS_TYPE).alias("b"))
    got = json.loads(df.select(F.to_json(E.normalise_basis(F.col("b")))).first()[0])
    assert got == [
        {"field": "ceo", "citations": [{"url": "u", "excerpts": []}], "confidence": "high"},
        {"url": "w", "title": "t", "excerpts": ["e"]},
    ]
    none = spark.range(1).select(E.normalise_basis(F.lit(None)).alias("b")).first().b
    assert none == []


def test_incremental_resolves_only_new_keys(companies, known):
    cache = companies.filter("id = 1").selectExpr("id", "'old' AS ceo_name")
    resolver = TableResolver(known, {"company": "k"}, {"ceo_name": "ceo"})
    got = E.enrich_new(companies, cache, ["id"], {"company": "name"}, ["CEO name"], resolver)
    assert {r.id: r.ceo_name for r in got.collect()} == {1: "old", 2: "Bob", 3: None, 4: None}


def test_filter_runs_below_the_resolver(companies):
    done = E.enrich(companies, {"name": "name"}, ["Shout"], CallableResolver(upper), where=F.col("id") < 3)
    plan = done.resolved._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter")


def test_unused_answers_are_not_read(spark, companies, known, tmp_path):
    known.write.parquet(str(tmp_path / "known"))
    table = spark.read.parquet(str(tmp_path / "known"))
    resolver = TableResolver(table, {"company": "k"}, {"ceo_name": "ceo", "founding_year": "year"}, unique=True)
    done = E.enrich(companies, {"company": "name"}, ["CEO name", "Founding year"], resolver)
    read = lambda df: df._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert read(done.table().select("id", "ceo_name")) == "struct<k:string,ceo:string>"
    assert read(done.metrics()) == read(done.errors()) == "struct<k:string>"


def test_hot_key_of_a_lookup_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("id", "IF(id % 3 = 0, 0, id % 5000) AS k", "uuid() AS payload")
        known = spark.range(5000).selectExpr("id AS k", "concat('v', id) AS v")
        resolver = TableResolver(known, {"key": "k"}, {"v": "v"}, unique=True)
        table = E.enrich(rows, {"key": "k"}, ["V"], resolver).table()
        assert len(table.collect()) == 60_000
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_call_that_hangs_leaves_the_other_answers(spark):
    def slow(rows, names):
        import time

        if rows[0]["n"] == "500":
            time.sleep(600)
        return [{"double": 2 * int(r["n"])} for r in rows]

    df = spark.range(1000).selectExpr("cast(id AS string) AS n").coalesce(1)
    resolver = CallableResolver(slow, chunk=1, parallel=8, deadline=8)
    done = E.enrich(df, {"n": "n"}, ["Double"], resolver)
    assert done.metrics().first().asDict() == {"total_count": 1000, "success_count": 999, "error_count": 1}
    assert [(r.n, r.error) for r in done.errors().collect()] == [("500", "timed out after 8s")]
    good, bad = E.typed_job(df, {"n": "n"}, [OutputColumn("double", "Double", "int")], resolver, stamp=False)
    assert good.agg(F.sum("double")).first()[0] == 2 * (sum(range(1000)) - 500)
    assert [r.error for r in bad.collect()] == ["timed out after 8s"]


def test_calls_at_a_time_keep_their_order(spark):
    df = spark.range(300).selectExpr("cast(id AS string) AS n")
    answers = lambda rows, names: [{"same": r["n"]} for r in rows]
    done = E.enrich(df, {"n": "n"}, ["Same"], CallableResolver(answers, chunk=7, parallel=3)).table()
    assert done.filter("n != same OR same IS NULL").count() == 0 and done.count() == 300
    with pytest.raises(ValueError):
        CallableResolver(answers, deadline=0)
