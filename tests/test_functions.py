import json

import pytest

from tablerich.functions import sql as S


def facts(rows, names):
    out = []
    for r in rows:
        if r.get("name") == "boom":
            out.append({"error": "boom"})
        else:
            out.append({**{n: f"{n}:{r.get('name')}" for n in names}, "basis": [{"field": names[0]}]})
    return out


@pytest.fixture
def registered(spark):
    S.register(spark, {"lite-fast": facts, "core": lambda rows, names: [None] * len(rows)}, include_basis=True, prefix="t_")
    yield spark
    S.unregister(spark, "t_")
    S.unregister(spark, "t_")


def test_scalar(registered):
    rows = registered.sql(
        """SELECT id, t_enrich(IF(id = 1, NULL, map('name', IF(id = 2, 'boom', concat('n', id)))),
                               IF(id = 3, array('One', 'Two'), array('One'))) AS a FROM range(5) ORDER BY id"""
    ).collect()
    got = [None if r.a is None else json.loads(r.a) for r in rows]
    assert got[0] == {"one": "one:n0", "_basis": [{"field": "one"}]}
    assert got[1] is None
    assert got[2] == {"error": "boom"}
    assert got[3] == {"one": "one:n3", "two": "two:n3", "_basis": [{"field": "one"}]}


def test_processor_per_row(registered):
    rows = registered.sql(
        """SELECT p, t_enrich_with_processor(map('name', 'x'), array('One'), p) AS a
           FROM VALUES ('core'), (''), (NULL), ('none') AS t(p)"""
    ).collect()
    got = {r.p: json.loads(r.a) for r in rows}
    assert got["core"] == {"error": "No result"}
    assert got[""]["one"] == got[None]["one"] == "one:x"
    assert got["none"] == {"error": "unknown processor: none"}


def test_json_form(registered):
    rows = registered.sql(
        """SELECT k, t_enrich_json(i, c) AS a FROM VALUES
           (1, '{"name":"x"}', '["One"]'), (2, 'bad', '["One"]'), (3, '{"name":"x"}', '{}'), (4, '{"name":"x"}', 'bad'),
           (5, NULL, '["One"]') AS t(k, i, c)"""
    ).collect()
    got = {r.k: json.loads(r.a) for r in rows}
    assert got[1]["one"] == "one:x"
    assert [got[k]["error"] for k in (2, 3, 4, 5)] == [
        "input: not JSON", "output columns: a JSON array is expected", "output columns: not JSON", "input: not JSON",
    ]


def test_odd_arguments_are_errors_of_their_row(registered):
    rows = registered.sql(
        """SELECT k, t_enrich_json(i, c) AS a FROM VALUES
           (1, '{"name":"x"}', '[1]'), (2, '{"name":"x"}', '[{}]'), (3, 'null', '["One"]'), (4, '5', '["One"]'),
           (5, '{"name":"x"}', '["One"]'), (6, '{"name":"x"}', '[""]') AS t(k, i, c)"""
    ).collect()
    got = {r.k: json.loads(r.a) for r in rows}
    assert got[5]["one"] == "one:x"
    assert all("error" in got[k] for k in (1, 2, 3, 4, 6))
    mixed = registered.sql(
        "SELECT k, t_enrich(map('name', 'x'), c) AS a FROM VALUES (1, array('One')), (2, array('One', NULL)) AS t(k, c)"
    ).collect()
    got = {r.k: json.loads(r.a) for r in mixed}
    assert got[1]["one"] == "one:x" and "error" in got[2]


def test_entity_function(registered):
    got = registered.sql("SELECT t_enrich_entity('Acme', 'a.com', array('One')) AS a").first().a
    assert json.loads(got)["one"] == "one:Acme"


def test_table_function_by_partition(registered):
    rows = registered.sql(
        """SELECT * FROM t_enrich_rows(TABLE(SELECT id % 2 AS g, IF(id = 4, 'bad', concat('{"name":"n', id, '"}'))
             AS input_json, array('One') AS output_columns FROM range(5)) PARTITION BY g)"""
    ).collect()
    assert len(rows) == 5
    assert {r.input for r in rows} == {"{}"} | {f'{{"name":"n{i}"}}' for i in range(4)}
    assert all("one" in json.loads(r.enriched) for r in rows)


def test_table_function_processor(registered):
    rows = registered.sql(
        """SELECT * FROM t_enrich_rows(TABLE(SELECT id % 2 AS g, concat('{"name":"n', id, '"}') AS input_json,
             array('One') AS output_columns, IF(id < 2, 'core', NULL) AS processor FROM range(4)) PARTITION BY g)"""
    ).collect()
    got = {json.loads(r.input)["name"]: json.loads(r.enriched) for r in rows}
    assert got["n0"] == got["n1"] == {"error": "No result"}
    assert got["n2"] == {"one": "one:n2", "basis": [{"field": "one"}]}


def test_table_function_flushes_large_groups(spark):
    sizes = S.table_function(lambda rows, names: [{"seen": len(rows)} for _ in rows], rows=10)
    df = spark.range(25).selectExpr("1 AS g", "id", "concat('{\"i\":', id, '}') AS input_json", "array('Seen') AS output_columns")
    rows = sizes(df.select("g", "input_json", "output_columns").asTable().partitionBy("g")).collect()
    assert sorted(json.loads(r.enriched)["seen"] for r in rows) == [5] * 5 + [10] * 20
    assert S.call_by_group(df, ["g"], ["id"], sizes, 10).count() == 25


def test_unregister(spark):
    S.register(spark, facts, prefix="gone_")
    S.unregister(spark, "gone_")
    assert not [f for f in spark.catalog.listFunctions() if f.name.startswith("gone_")]
