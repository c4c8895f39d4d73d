import json
import os

import pytest
from pyspark.sql import functions as F

from tablerich.operators.naming import OutputColumn
from tablerich.operators.resolvers import ExprResolver, TableResolver
from tablerich.plans import jobs
from tablerich.sources import readers, writers

ROWS = [("Acme, Inc.", "a.com"), ('Quote "Q"', None), ("Two\nlines", "t.com")]


@pytest.fixture
def companies(spark):
    return spark.createDataFrame(ROWS, "name string, site string")


def test_csv_round_trip(spark, companies, tmp_path):
    path = str(tmp_path / "out.csv")
    writers.write_csv(companies, path)
    back = readers.read_csv(spark, path, line_breaks=True)
    assert back.schema.simpleString() == "struct<name:string,site:string>"
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        readers.read_csv(spark, path).select("name").collect()
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)
    writers.write_csv(companies.limit(0), path)
    assert readers.read_csv(spark, path).columns == ["name", "site"]


def test_json_round_trip(spark, companies, tmp_path):
    path = str(tmp_path / "out.json")
    writers.write_json(companies, path)
    back = readers.read_json(spark, path, lines=True).select("name", "site")
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)
    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"a": "1"}, {"a": "2"}], indent=2))
    assert {r.a for r in readers.read_json(spark, str(array)).collect()} == {"1", "2"}
    (tmp_path / "bad.json").write_text("[{")
    with pytest.raises(Exception):
        readers.read_json(spark, str(tmp_path / "bad.json"), "a string").collect()


def test_tables(spark, companies):
    writers.replace_table(companies, "firms")
    writers.append_table(companies, "firms")
    assert spark.table("firms").count() == 6
    writers.replace_table(companies, "firms")
    assert readers.read_table(spark, "firms").count() == 3
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        writers.result_table(companies, "firms")
    assert writers.result_table(companies.limit(1), "firms2").count() == 1
    assert writers.result_table(companies, "firms2", replace=True).count() == 3
    assert writers.result_table(companies, None, view="firm_view").count() == 3
    assert readers.read_source(spark, "firms", ["site"]).columns == ["site"]
    assert readers.read_source(spark, " select *, 1 AS one FROM firms", ["site"]).columns == ["name", "site", "one"]


def test_names_are_quoted_or_refused():
    assert readers.quote_name("a.b c.d`e") == "`a`.`b c`.`d``e`"
    for bad in ("", " ", "a..b"):
        with pytest.raises(ValueError):
            readers.quote_name(bad)
    for bad in ("", "1a", "a;b", "a b", "a-b"):
        with pytest.raises(ValueError):
            readers.check_table_name(bad)
    assert readers.check_table_name("s.t_1") == "s.t_1"


def test_columns_and_detected_config(companies):
    found = [tuple(r) for r in readers.source_columns(companies).collect()]
    assert found == [(1, "name", "string", 3), (2, "site", "string", 2)]
    config = readers.detected_config(companies, "s", "t", "csv", [{"name": "x", "description": "d"}])
    assert jobs.parse_config(config).inputs == {"name": "name", "site": "site"}


def test_inline_rows_of_a_user(spark):
    df, columns = readers.read_inline(spark, '[{"company":"A","industry":"x"},{"company":"B"}]')
    assert columns[1] == {"name": "industry", "description": "The industry field"}
    assert {tuple(r) for r in df.collect()} == {("A", "x"), ("B", None)}
    for bad, why in {"{}": "array", "x": "JSON", "[]": "empty", '["a"]': "objects", "[{}]": "one field"}.items():
        with pytest.raises(ValueError, match=why):
            readers.read_inline(spark, bad)


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("r1", "text", "# T\n\nbody"), ("r2", "json", '{"a":1}')], "run_id string, kind string, content string")
    path = str(tmp_path / "reports")
    writers.write_reports(df, path, is_text=F.col("kind") == "text")
    meta = {r.run_id: r for r in spark.read.json(f"{path}/metadata").collect()}
    assert meta["r2"].content == '{"a":1}' and meta["r1"].content is None
    assert os.listdir(f"{path}/markdown/run_id=r1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_reports(df, path)
    writers.write_reports(df, path, force=True)
    rows = str(tmp_path / "rows")
    writers.write_reports(df, rows, folders=False)
    assert spark.read.json(f"{rows}/markdown").count() == 2


def test_cache(spark, companies, tmp_path):
    path = str(tmp_path / "cache")
    writers.append_cache(companies, path)
    writers.append_cache(companies, path)
    back = spark.read.parquet(path)
    assert back.count() == 6 and back.filter("enriched_at IS NULL").count() == 0


CONFIG = {
    "source": "in.csv",
    "target": "out",
    "source_type": "csv",
    "source_columns": [{"name": "name", "description": "the name"}],
    "enriched_columns": [{"name": "letters", "description": "length of the name", "type": "int"}],
}


def letters():
    return ExprResolver({"letters": F.length("name")})


def test_run_from_yaml(spark, companies, tmp_path):
    writers.write_csv(companies, str(tmp_path / "in"))
    config = {**CONFIG, "source": str(tmp_path / "in"), "target": str(tmp_path / "out"), "options": {"line_breaks": "true"}}
    import yaml

    (tmp_path / "job.yaml").write_text(yaml.safe_dump(config))
    job = jobs.load_config(str(tmp_path / "job.yaml"))
    assert job.processor == "core-fast"
    jobs.run_job(spark, job, letters())
    out = readers.read_csv(spark, job.target, line_breaks=True)
    assert out.columns == ["name", "letters", "batch_id", "insertion_timestamp"]
    assert {r.name: r.letters for r in out.collect()}["Acme, Inc."] == "10"
    preview = jobs.dry_run(spark, job).first()
    assert (preview.processor, preview.inputs, preview.outputs, preview.rows) == ("core-fast", "name", "letters", 3)


@pytest.mark.parametrize("kind", ["json", "parquet", "table"])
def test_other_targets(spark, companies, tmp_path, kind):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    if kind == "table":
        companies.createOrReplaceTempView("job_source")
        source, target = "job_source", "job_target"
    else:
        companies.write.format(kind).save(source)
    if kind == "json":
        (tmp_path / "a.json").write_text(json.dumps([{"name": n, "site": s} for n, s in ROWS]))
        source = str(tmp_path / "a.json")
    jobs.run_job(spark, {**CONFIG, "source_type": kind, "source": source, "target": target}, letters())
    out = spark.table(target) if kind == "table" else spark.read.format(kind).load(target)
    assert out.count() == 3


def test_submit_without_resolving(spark, companies, tmp_path):
    companies.createOrReplaceTempView("job_source")
    job = jobs.parse_config({**CONFIG, "source_type": "table", "source": "job_source"})
    queued, summary = jobs.submit_job(spark, job, "g1")
    queued.write.parquet(str(tmp_path / "ledger"))
    rows = spark.read.parquet(str(tmp_path / "ledger")).collect()
    assert len({r.run_id for r in rows}) == 3 and {r.status for r in rows} == {"queued"}
    assert {json.loads(r.input)["name"] for r in rows} == {n for n, _ in ROWS}
    assert summary.first().asDict() == {"group_id": "g1", "num_runs": 3}


def test_processor_chooses_the_resolver(spark, companies):
    companies.createOrReplaceTempView("job_source")
    job = jobs.parse_config({**CONFIG, "source_type": "table", "source": "job_source", "processor": "base"})
    zero = ExprResolver({"letters": F.lit(0)})
    good, _ = jobs.build_job(spark, job, {"core-fast": letters(), "base": zero})
    assert {r.letters for r in good.collect()} == {0}
    with pytest.raises(jobs.ConfigError, match="base"):
        jobs.build_job(spark, job, {"core-fast": letters()})


def test_bad_configs(tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.load_config(str(tmp_path / "none.yaml"))
    for change in ({"source_type": "xml"}, {"source_columns": []}, {"enriched_columns": [{"name": "x"}]}):
        with pytest.raises(jobs.ConfigError):
            jobs.parse_config({**CONFIG, **change})
    with pytest.raises(jobs.ConfigError, match="missing: target"):
        jobs.parse_config({k: v for k, v in CONFIG.items() if k != "target"})


def test_many_jobs_go_on_after_a_failure(spark, companies):
    companies.createOrReplaceTempView("job_source")
    good = {**CONFIG, "source_type": "table", "source": "job_source"}
    missing = {**good, "source_columns": [{"name": "web", "description": "absent"}]}
    known = companies.select(F.col("name").alias("k"), F.length("name").alias("n")).filter("n > 9")
    resolver = TableResolver(known, {"name": "k"}, {"letters": "n"})
    rows, status = jobs.run_many(spark, [("a", good), ("b", missing), ("c", good)], resolver)
    assert {r.job: (r.status, r.rows, r.dropped) for r in status.collect()} == {
        "a": ("success", 1, 2), "b": ("failed", 0, 0), "c": ("success", 1, 2)
    }
    assert {r.job: r["count"] for r in rows.groupBy("job").count().collect()} == {"a": 1, "c": 1}
    assert jobs.totals(status).first().asDict() == {"jobs": 3, "succeeded": 2, "failed": 1}


def test_a_failure_at_run_time_leaves_the_others_written(spark, companies, tmp_path):
    companies.createOrReplaceTempView("job_source")
    path = lambda n: str(tmp_path / n)
    companies.write.parquet(path("in"))
    config = lambda n: {**CONFIG, "source_type": "parquet", "source": path("in"), "target": path(n)}
    trap = ExprResolver({"letters": F.when(F.col("name") != "", F.raise_error(F.lit("broken row"))).otherwise("1").cast("string")})
    chosen = {"core-fast": letters(), "base": trap}
    bad = {**config("b"), "processor": "base"}
    _, status = jobs.run_many(spark, [("a", config("a")), ("b", bad), ("c", config("c"))], chosen)
    assert {r.job: r.status for r in status.collect()} == {"a": "success", "b": "failed", "c": "success"}
    assert spark.read.parquet(path("a")).count() == spark.read.parquet(path("c")).count() == 3


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_a_job_keeps_every_row_of_many_files(spark, tmp_path, kind):
    many = spark.range(1000).selectExpr("concat('n', id) AS name", "IF(id % 2 = 0, NULL, 's') AS site").repartition(7)
    source, target, dropped = (str(tmp_path / n) for n in ("in", "out", "dropped"))
    (writers.write_json if kind == "json" else writers.write_csv)(many, source)
    config = {**CONFIG, "source_type": kind, "source": source, "target": target, "options": {"dropped": dropped}}
    odd = ExprResolver({"letters": F.when(F.col("name") != "n7", F.length("name"))})
    assert jobs.dry_run(spark, jobs.parse_config(config)).first().rows == 1000
    left = jobs.run_job(spark, config, odd).collect()
    assert [r.name for r in left] == ["n7"] and spark.read.parquet(dropped).count() == 1
    again = jobs.read_job(spark, jobs.parse_config({**config, "source": target}))
    assert again.count() == 999 and {r.name for r in again.collect()} == {f"n{i}" for i in range(1000)} - {"n7"}


def test_arrays_and_lines_are_told_apart(spark, companies, tmp_path):
    lines, pretty = str(tmp_path / "lines"), tmp_path / "pretty.json"
    writers.write_json(companies, lines)
    pretty.write_text(json.dumps([{"name": n, "site": s} for n, s in ROWS], indent=2))
    one_line = tmp_path / "one.json"
    one_line.write_text(json.dumps([{"name": n, "site": s} for n, s in ROWS]))
    for path in (lines, str(pretty), str(one_line)):
        assert readers.read_json(spark, path).count() == 3
    with pytest.raises(ValueError, match="as lines"):
        readers.read_json(spark, lines, lines=False)


def test_lists_reach_tables_and_csv(spark, companies, tmp_path):
    from tablerich.operators import enrich as E
    from tablerich.operators.resolvers import CallableResolver

    listed = OutputColumn("parts", "Parts of the name", "list[str]")
    numbers = OutputColumn("sizes", "Their sizes", "list[int]")
    split = F.split("name", " ")
    known = companies.select(F.col("name").alias("k"), split.alias("p"), F.transform(split, F.length).alias("s"))
    resolvers = [
        TableResolver(known, {"name": "k"}, {"parts": "p", "sizes": "s"}),
        ExprResolver({"parts": split, "sizes": F.transform(split, F.length)}),
        CallableResolver(lambda rows, names: [{"parts": r["name"].split(" "), "sizes": [len(x) for x in r["name"].split(" ")]} for r in rows]),
    ]
    for resolver in resolvers:
        done = E.enrich(companies, {"name": "name"}, [listed, numbers], resolver).table()
        assert {r.name: (r.parts, r.sizes) for r in done.collect()} == {n: (n.split(" "), [len(x) for x in n.split(" ")]) for n, _ in ROWS}
    path = str(tmp_path / "lists")
    writers.write_csv(done, path)
    assert {r.parts for r in readers.read_csv(spark, path, line_breaks=True).collect()} >= {'["Acme,","Inc."]'}


def test_costly_answers_are_asked_for_once(spark, tmp_path):
    from tablerich.operators import enrich as E
    from tablerich.operators.resolvers import CallableResolver

    counter = str(tmp_path / "calls")

    def counted(rows, names):
        with open(counter, "a") as f:
            f.write("x" * len(rows))
        return [{"shout": r["name"]} for r in rows]

    many = spark.range(100).selectExpr("concat('n', id) AS name")
    done = E.enrich(many, {"name": "name"}, [OutputColumn("shout", "Louder")], CallableResolver(counted))
    assert done.table().count() == 100 and done.errors().count() == 0 and done.metrics().first().success_count == 100
    good, bad = E.typed_job(many, {"name": "name"}, [OutputColumn("shout", "Louder")], CallableResolver(counted))
    assert good.count() == 100 and bad.count() == 0
    assert os.path.getsize(counter) == 200


def test_declared_types_are_known():
    assert OutputColumn("a", "b", "list[str]").spark_type.simpleString() == "array<string>"
