import json

import pytest
from pyspark.sql import functions as F

from tablerich.operators import naming as N
from tablerich.operators import inputs as I

CASES = {
    "Crew size": "crew_size",
    "Crew size (at sea)": "crew_size",
    "Launch date (ISO form)": "launch_date",
    "Draught [metres]": "draught",
    "Hull type {wood/steel}": "hull_type",
    "3rd deck": "col_3rd_deck",
    "Captain's rank & pay!": "captains_rank__pay",
    "(all in brackets)": "column",
    "ship-to-shore radio": "ship_to_shore_radio",
    "_x": "col__x",
    "": "column",
    "\tHead count\n": "head_count",
    "Größe in ½ Meter": "größe_in_½_meter",
    "½ share": "col_½_share",
    "!!!": "column",
    "a [b] (c)": "a",
    " Umsatz ": "umsatz",
}


def test_names(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "d string").select("d", N.name_of(F.col("d")).alias("n"))
    assert {r.d: r.n for r in df.collect()} == CASES
    assert {d: N.derive_name(d) for d in CASES} == CASES


def test_repeated_name_keeps_place_and_takes_last_text():
    columns = N.output_columns(["CEO (a)", "Year", "CEO (b)"])
    assert [(c.name, c.description) for c in columns] == [("ceo", "CEO (b)"), ("year", "Year")]


def test_output_struct_has_types_and_descriptions():
    struct = N.output_struct([N.OutputColumn("n", "a number", "int"), "CEO name"])
    assert struct["n"].dataType.simpleString() == "bigint"
    assert struct["ceo_name"].metadata == {"description": "CEO name"}
    assert N.OutputColumn("x", "odd", "decimal").spark_type.simpleString() == "string"
    assert len(N.DECLARED_TYPES) == 16


def test_schema_json(spark):
    df = spark.createDataFrame([(["CEO (a)", "Year \"q\"", "CEO (b)"],)], "d array<string>")
    got = json.loads(df.select(N.schema_json(F.col("d"))).first()[0])
    assert got["required"] == ["ceo", "year_q"]
    assert got["properties"]["ceo"] == {"type": "string", "description": "CEO (b)"}
    assert got["properties"]["year_q"]["description"] == 'Year "q"'


@pytest.mark.parametrize(
    "kind,good,bad",
    [("int", " 12 ", "12x"), ("float", "-1.5e3", "one"), ("bool", "True", "maybe"), ("date", "2024-02-03", "soon"),
     ("datetime", "2024-02-03 04:05:06", "later"), ("list[int]", "[1,2]", "nope"), ("int", "+7", "99999999999999999999"),
     ("float", ".5", ""), ("date", "2024-02-03", "2024-13-40")],
)
def test_casts(spark, kind, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "t string").select(N.cast_declared(F.col("t"), kind).alias("v"))
    values = [r.v for r in df.collect()]
    assert values[0] is not None and values[1] is None


def test_inputs_drop_nulls_and_check_columns(spark):
    df = spark.createDataFrame([("Acme", None, 3)], "a string, b string, c int")
    inputs = {"name": "a", "site": "b", "size": "c"}
    row = df.select(I.input_map(inputs).alias("m"), I.input_json(inputs).alias("j")).first()
    assert row.m == {"name": "Acme", "size": "3"}
    assert json.loads(row.j) == row.m
    assert df.select(I.input_map({}).alias("m")).first().m == {}
    with pytest.raises(ValueError, match="missing_one"):
        I.check_columns(df, {"x": "missing_one"})


def test_inline_rows(spark):
    texts = [
        ("ok", '[{"company":"A","industry":"x"},{"company":"B","extra":1},5,{"company":"C"}]'),
        ("text", "not json"),
        ("object", '{"a":1}'),
        ("empty", "[]"),
        ("scalars", '["a"]'),
        ("blank", "[{}]"),
    ]
    df = I.parse_inline_rows(spark.createDataFrame(texts, "id string, t string"), "t", "id")
    got = {}
    for r in df.collect():
        got.setdefault(r.id, []).append((r.ordinal, r.row, r.error))
    assert sorted(got["ok"]) == [
        (1, {"company": "A", "industry": "x"}, None), (2, None, "Unknown fields: extra"), (3, None, "The element is not an object"),
        (4, {"company": "C"}, None),
    ]
    assert [got[k][0][2] for k in ("text", "object", "empty", "scalars", "blank")] == [
        "The text is not JSON",
        "A JSON array is expected",
        "The array is empty",
        "The array must hold objects",
        "An object needs at least one field",
    ]


def test_comma_lists(spark):
    df = spark.createDataFrame([([" a, b ", "c,,", "", "d"],)], "v array<string>")
    assert df.select(I.comma_list(F.col("v")).alias("o")).first().o == ["a", "b", "c", "d"]
