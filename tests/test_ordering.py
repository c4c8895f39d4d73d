import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablerich.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another third one moment."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40)
        moment = 5 if i % 3 == 1 else rng.randrange(100)
        rows.append((key, moment, i, rng.choice(["a", "b", None])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k int, t int, id int, state string").repartition(6)


def test_row_numbers(skewed, many_parts):
    got = O.number_rows(skewed, ["t", "id"]).toPandas().sort_values("row_number")
    assert got["row_number"].tolist() == list(range(1, 3001))
    assert got[["t", "id"]].values.tolist() == sorted(got[["t", "id"]].values.tolist())


def test_batches(skewed, many_parts):
    sizes = O.batch_ids(skewed, [F.desc("t"), F.asc("id")], 700).groupBy("batch_id").count().collect()
    assert sorted((r.batch_id, r["count"]) for r in sizes) == [(1, 700), (2, 700), (3, 700), (4, 700), (5, 200)]
    assert O.batch_slice(skewed, ["id"], 2, 10).toPandas()["id"].sort_values().tolist() == list(range(10, 20))


def test_chunk_sizes(skewed):
    rows = O.chunk_sizes(skewed.filter("k = 1"), ["k"], 300).collect()
    assert sorted((r.chunk, r.rows) for r in rows) == [(1, 300), (2, 300), (3, 300), (4, 100)]


def brute(pdf):
    pdf = pdf.sort_values(["k", "t", "id"]).reset_index(drop=True)
    out = {}
    for _, g in pdf.groupby("k"):
        before = None
        for n, r in enumerate(g.itertuples()):
            out[r.id] = (n == 0, before if n else None, r.state)
            before = r.state
    return out


@pytest.mark.parametrize("batch", [10_000, 7])
@pytest.mark.parametrize("changed_only", [False, True])
def test_previous_row(spark, skewed, many_parts, changed_only, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = O.with_previous(skewed, "k", ["t", "id"], "state", changed_only).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    clean = lambda v: None if pd.isna(v) else v
    expected = brute(skewed.toPandas())
    if changed_only:
        expected = {i: v for i, v in expected.items() if v[0] or clean(v[1]) != clean(v[2])}
    assert len(got) == len(expected)
    for r in got.itertuples():
        first, previous, state = expected[r.id]
        assert (r.first, clean(r.previous), clean(r.state)) == (first, clean(previous), clean(state))


@pytest.mark.parametrize("batch", [10_000, 7])
@pytest.mark.parametrize("key", [["k"], ["k", "state"]])
def test_running_totals(spark, skewed, many_parts, batch, key):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = skewed.withColumns({"n": F.lit(1).cast("bigint"), "x": F.col("id") / 4})
        got = O.running_totals(df, key, ["t", "id"], ["n", "x"]).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    rows = skewed.toPandas().sort_values(["t", "id"])
    rows["n"] = rows.groupby(key, dropna=False).cumcount() + 1
    rows["x"] = (rows["id"] / 4).groupby([rows[k].fillna("") for k in key]).cumsum()
    want = rows.set_index("id")
    assert len(got) == 3000
    for r in got.itertuples():
        assert r.n == want.n[r.id] and abs(r.x - want.x[r.id]) < 1e-6


def test_large_keys_with_nulls_stay_exact(spark, many_parts):
    big = 2**53
    rows = [(None if i % 7 == 0 else big + i % 3, big + i, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, t long, s string").repartition(5)
    got = O.with_previous(df, "k", ["t"], "s").collect()
    assert {(r.k, r.t, r.s) for r in got} == set(rows)
    assert sum(r["first"] for r in got) == 4
    totals = O.running_totals(df.withColumn("n", F.lit(1).cast("bigint")), ["k"], ["t"], ["n"]).collect()
    assert {(r.k, r.t) for r in totals} == {(k, t) for k, t, _ in rows}
    assert sum(r.n == 1 for r in totals) == 4


def test_scratch_tables_can_be_cleared(spark):
    from tablerich.session import clear_scratch, cut_lineage

    clear_scratch(spark)
    kept = cut_lineage(spark.range(10))
    assert kept.count() == 10
    assert clear_scratch(spark) == 1 and clear_scratch(spark) == 0


@pytest.mark.parametrize("kind", ["id", "cast(id % 7 AS int)", "CASE WHEN id % 3 > 0 THEN id * 0.5D END", "date_add(DATE '2024-01-01', cast(id % 40 AS int))",
                                  "concat('k', id % 11)", "timestamp_ntz'2024-01-01 00:00:00'", "cast(NULL AS bigint)", "IF(id % 5 = 0, double('NaN'), -id)"])
def test_a_batch_by_rank(spark, kind):
    df = spark.range(3000).selectExpr(f"{kind} AS a", "hash(id) AS b", "id").repartition(5)
    whole = [r.id for r in df.orderBy("a", "b", "id").collect()]
    for batch, size in ((1, 100), (15, 100), (31, 100)):
        found = O.batch_slice(df, ["a", "b", "id"], batch, size).orderBy("a", "b", "id").collect()
        assert [r.id for r in found] == whole[(batch - 1) * size : batch * size]
    falling = [F.desc("a"), F.desc("b"), "id"]
    whole = [r.id for r in df.orderBy(*falling).collect()]
    for batch, size in ((29, 100),):
        found = O.batch_slice(df, falling, batch, size).orderBy(*falling).collect()
        assert [r.id for r in found] == whole[(batch - 1) * size : batch * size]


def test_a_batch_sorts_a_part_of_the_table(spark):
    near, before = O._around(spark.range(100_000).repartition(4), "id", 40_000, 40_100)
    assert before <= 40_000 and near.count() < 2000
