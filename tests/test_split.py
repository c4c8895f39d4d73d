import csv
import io
import json
import random

import pytest

from tablerich.sources import readers, split


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


VALUES = ["", "plain", 'a "quoted" word', "line\nbreak", "two\n\nbreaks\n", ",", '","', "é漢\U0001f600", '"', '""', "}", "{[", "\\", '\\"}', "a\\\\", "x" * 150, "\t "]


def table(seed, n):
    rng = random.Random(seed)
    return [{"id": str(i), "a": rng.choice(VALUES), "b": "".join(rng.choices(VALUES, k=3))} for i in range(n)]


@pytest.mark.parametrize("size", [200, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_with_line_breaks(spark, tmp_path, small_ranges, size, end):
    small_ranges(size)
    rows = []
    for part in range(2):
        some = [{**r, "id": f"{part}-{r['id']}"} for r in table(part, 25)]
        out = io.StringIO(newline="")
        writer = csv.DictWriter(out, ["id", "a", "b"], lineterminator=end, quoting=csv.QUOTE_ALL)
        writer.writeheader()
        writer.writerows(some)
        (tmp_path / f"{part}.csv").write_bytes(out.getvalue().encode().removesuffix(end.encode() if part == 1 else b""))
        rows += some
    found = readers.read_csv(spark, str(tmp_path), line_breaks=True)
    assert found.columns == ["id", "a", "b"]
    assert sorted((r.id, r.a, r.b) for r in found.collect()) == sorted((r["id"], r["a"] or None, r["b"] or None) for r in rows) or sorted(
        (r.id, r.a or "", r.b or "") for r in found.collect()
    ) == sorted((r["id"], r["a"], r["b"]) for r in rows)
    assert found.select("id").count() == 50
    if size == 200:
        assert split._read(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 10


@pytest.mark.parametrize("size, indent", [(300, 0), (300, None), (1 << 20, 2)])
def test_json_arrays(spark, tmp_path, small_ranges, size, indent):
    small_ranges(size)
    rows = []
    for part in range(2):
        some = [{**r, "id": f"{part}-{r['id']}", "more": {"deep": [{"x": r["a"]}, {}, [1, {"y": "]}"}]]}} for r in table(part + 5, 15)]
        (tmp_path / f"{part}.json").write_text(json.dumps(some, indent=indent, ensure_ascii=part == 0), encoding="utf-8")
        rows += some
    found = readers.read_json(spark, str(tmp_path), "id string, a string, b string, more string", lines=False)
    got = sorted((r.id, r.a, r.b, json.dumps(json.loads(r.more))) for r in found.collect())
    assert got == sorted((r["id"], r["a"], r["b"], json.dumps(r["more"])) for r in rows)
    assert set(readers.read_json(spark, str(tmp_path), lines=False).columns) == {"id", "a", "b", "more"}


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1},', '[{"a": 1}, {"a"', '[{"a": "x}]', '{"a": 1}', ""])
def test_what_is_no_array_raises(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    if not text:
        assert readers.read_json(spark, str(tmp_path), "a string", lines=False).count() == 0
        return
    with pytest.raises(ValueError):
        readers.read_json(spark, str(tmp_path), "a string", lines=False).collect()


@pytest.mark.parametrize("text", ['[1, {"a": 2}]', '[{"a": 1}, 5]', '[{"a": 1} {"a": 2}, "x"]'])
def test_elements_that_are_no_objects_raise(spark, tmp_path, text):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception):
        readers.read_json(spark, str(tmp_path), "a string", lines=False).collect()


def test_empty_arrays_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.json").write_text(" [ ]\n")
    (tmp_path / "b.json").write_text("﻿[{}]")
    assert readers.read_json(spark, str(tmp_path), "a string", lines=False).count() == 1
    (tmp_path / "c.csv").write_text('a,b\n"1,2\n')
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "c.csv"), line_breaks=True).collect()
