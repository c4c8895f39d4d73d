"""Plans that must hold for hot keys and for caps."""

import pytest
from pyspark.sql import functions as F

from tablerich.operators import discovery as D
from tablerich.operators import enrich as E
from tablerich.operators import memory as Y
from tablerich.operators import monitor as M
from tablerich.operators.resolvers import TableResolver

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed_session(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark):
    return spark.range(40_000).selectExpr("IF(id % 10 < 9, 1, id) AS k", "uuid() AS pad", "id").repartition(8)


def test_hot_keys_of_a_lookup_are_split(skewed_session):
    spark = skewed_session
    known = spark.range(1, 40_000).selectExpr("id AS k", "concat('a', id % 7) AS a", "id % 3 AS z").repartition(4)
    twice = known.unionByName(known)
    done = E.enrich(hot(spark), {"key": "k"}, ["Answer"], TableResolver(twice, {"key": "k"}, {"answer": "a"})).table()
    assert "skew=true" in final_plan(done)
    assert done.filter("answer IS NULL").count() == done.filter("k = 0").count()


def test_hot_scopes_are_split_when_cleared(skewed_session):
    spark = skewed_session
    entries = hot(spark).selectExpr("k AS scope", "pad", "id AS updated_at")
    cleared = spark.range(0, 40_000).selectExpr("id AS scope", "10 AS cleared_at").repartition(4)
    left = Y.clear(entries, cleared)
    assert "skew=true" in final_plan(left)
    assert left.count() == 40_000 - 11


def test_paging_at_the_largest_limit_loses_nothing(spark):
    df = spark.range(10_001).selectExpr("CAST(id AS int) AS id", "IF(id < 3, NULL, id) AS at")
    first = M.page(df, ["at", "id"], 10_000)
    cursor = M.next_cursor(df, ["at", "id"], 10_000)
    rest = M.page(df, ["at", "id"], 10_000, cursor)
    assert first.count() == 10_000 and [r.id for r in rest.collect()] == [0]
    assert M.next_cursor(df, ["at", "id"], 10_000, cursor) is None


def test_pages_reach_rows_without_a_date(spark):
    rows = [(i, None if i % 3 else i) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, at int")
    seen, cursor = [], None
    while True:
        seen += [r.id for r in M.page(df, ["at", "id"], 3, cursor).collect()]
        cursor = M.next_cursor(df, ["at", "id"], 3, cursor)
        if cursor is None:
            break
    assert sorted(seen) == list(range(20)) and len(seen) == 20


def test_unknown_frequencies_are_told(spark):
    df = spark.createDataFrame([(1, 1, "daily"), (2, 1, "45d"), (3, 1, None)], "k int, d int, frequency string")
    df = df.selectExpr("k", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS start", "frequency")
    due = M.schedule(df, "k", "start", F.lit("2024-01-02").cast("timestamp_ntz")).collect()
    assert sorted((r.k, r.trigger) for r in due) == [
        (1, "schedule"), (1, "schedule"), (2, "invalid frequency: 45d"), (3, "invalid frequency: null")
    ]


def discovery(entities, limit=5):
    always = D.Condition("any", "always met", F.lit(True))
    return D.Discovery("things", "companies", entities, "id", [always], F.col("s"), match_limit=limit)


def test_extension_goes_on_where_the_run_ended(spark):
    rows = [(i, float(i) if i < 8 else None if i < 11 else float("nan")) for i in range(12)]
    found = discovery(spark.createDataFrame(rows, "id int, s double"))
    first, more = [r.id for r in found.run().collect()], [(r.id, r["rank"]) for r in found.extend(20).collect()]
    assert first == [11, 7, 6, 5, 4]
    assert sorted(more, key=lambda m: m[1]) == list(zip([3, 2, 1, 0, 8, 9, 10], range(6, 13)))
    with pytest.raises(ValueError):
        found.extend(0)
    with pytest.raises(ValueError):
        found.extend(1001)


def test_objectives_without_a_match_have_an_empty_list(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 3, 3.0)], "o string, id int, s double")
    met = D.Condition("small", "small", F.col("id") < 3)
    candidates = D.Discovery("things", "companies", df, "id", [met], F.col("s"), generator="pro").candidates()
    candidates = candidates.withColumn("output", F.when(F.col("id") != 2, F.col("output")))
    got = {r.o: r.candidates for r in D.as_json(candidates, "o", [F.desc("s")]).collect()}
    assert got["b"] == "[]" and '"id":"2"' in got["a"] and '"id":"1"' in got["a"]
