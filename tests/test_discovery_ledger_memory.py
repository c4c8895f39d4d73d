import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablerich.operators import costs
from tablerich.operators import discovery as D
from tablerich.operators import ledger as L
from tablerich.operators import memory as M
from tablerich.operators.resolvers import ExprResolver

OUT = D.OUTPUT_TYPE


@pytest.fixture(scope="module")
def firms(spark):
    rows = [(i, f"Firm {i}", f"https://f{i}.com/", i * 1.0, i % 2 == 0) for i in range(1, 41)]
    return spark.createDataFrame(rows, "id int, name string, url string, size double, even boolean")


def discovery(firms, **kw):
    return D.Discovery(
        "even firms", "companies", firms, "id",
        [D.Condition("even", "is even", F.col("even")), D.Condition("big", "over 10", F.col("size") > 10)],
        F.col("size"), **kw,
    )


def test_run_extend_and_tiers(firms):
    top = [r.id for r in discovery(firms, match_limit=5).run().collect()]
    assert top == [40, 38, 36, 34, 32]
    assert [r.id for r in discovery(firms, match_limit=5).extend(3).orderBy("rank").collect()] == [30, 28, 26]
    for tier in D.GENERATORS:
        assert [r.id for r in discovery(firms, match_limit=5, generator=tier).run().collect()] == top
    pools = [discovery(firms, generator=t).pool().count() for t in D.GENERATORS]
    assert pools == sorted(pools) and pools[-1] == 40
    with pytest.raises(ValueError):
        discovery(firms, match_limit=4)
    with pytest.raises(ValueError):
        discovery(firms, generator="huge")


def test_exclusions(spark, firms):
    exclude = spark.createDataFrame([("FIRM-40!", None), (None, "http://f38.com/page")], "name string, url string")
    found = discovery(firms, match_limit=5).run(exclude=exclude, name="name", url="url")
    assert [r.id for r in found.collect()] == [36, 34, 32, 30, 28]


def test_flatten_missing_fields_and_order(spark):
    rows = [
        (1, "c1", "matched", "A", {"url": ("enrichment", "u", None)}, ["x"]),
        (2, "c2", "generated", "B", {"hidden": ("enrichment", "h", None)}, ["x"]),
        (3, "c3", "matched", "C", {"industry": ("enrichment", "i", None), "url": ("enrichment", None, None)}, None),
    ]
    df = spark.createDataFrame(rows, f"id int, candidate_id string, match_status string, name string, output {OUT}, tags array<string>")
    flat = D.flatten(df, "id")
    assert flat.columns == ["id", "name", "tags", "url", "industry"]
    assert sorted(map(tuple, flat.collect())) == [("1", "A", '["x"]', "u", None), ("3", "C", None, None, "i")]
    none = D.flatten(df.filter("id = 2"), "id")
    assert none.count() == 0


def test_json_and_back(firms):
    candidates = discovery(firms).candidates().withColumn("objective", F.lit("o"))
    arrays = D.as_json(candidates.drop("even", "conditions_met"), "objective", [F.desc("score"), F.asc("id")], 5)
    items = json.loads(arrays.first().candidates)
    assert [i["id"] for i in items] == ["40", "38", "36", "34", "32"]
    assert "match_status" not in items[0] and items[0]["even"] == "true"
    assert D.from_json_rows(arrays, "objective", "candidates", ["id", "name"]).count() == 5


def test_enrich_matches_and_coverage(firms):
    candidates = discovery(firms).candidates()
    resolver = ExprResolver({"site": F.col("url")}, error=F.when(F.col("size") > 38, "none"))
    done = D.enrich_matched(candidates, {"url": "url"}, ["Site"], resolver)
    assert done.count() == 35  # five firms meet no condition
    row = D.coverage(done, ["even", "site"]).first()
    assert (row.total, row.enriched, row.done) == (15, 14, False)
    assert D.metrics(done).first().asDict() == {"generated": 35, "matched": 15}
    assert D.coverage(done.filter("id = 1"), ["site"]).first().done is True


def test_table_with_enrichments(firms):
    site = D.Enrichment(["Site"], {"url": "url"}, ExprResolver({"site": F.col("url")}))
    letters = D.Enrichment(["Letters (count)"], {"name": "name"}, ExprResolver({"letters": F.length("name")}))
    found = discovery(firms.select("id", "name", "url", "size", "even"), match_limit=5, enrichments=[site, letters])
    table = found.table()
    assert table.columns == ["id", "name", "url", "size", "even", "conditions_met", "score", "big", "site", "letters"]
    assert {r.id: r.letters for r in table.collect()} == {str(i): "7" for i in (40, 38, 36, 34, 32)}
    assert "site" not in found.table(enrich=False).columns


def test_entity_search_checks(firms):
    with pytest.raises(ValueError):
        D.entity_search({}, "planets", "x")


@pytest.fixture(scope="module")
def ledger(spark):
    t = datetime(2024, 1, 1)
    rows = [
        ("g1", "a", "completed", "out", None), ("g1", "b", "failed", None, "bad"), ("g1", "c", "cancelled", None, None),
        ("g2", "d", "running", None, None), ("g2", "e", "queued", None, None), ("g2", "f", "completed", None, None),
    ]
    return spark.createDataFrame(
        [(*r, "in", t if r[1] != "e" else datetime(2024, 1, 9)) for r in rows],
        "group_id string, run_id string, status string, output string, error string, input string, created_at timestamp",
    )


def test_ledger(ledger):
    status = {r.group_id: r for r in L.group_status(ledger).collect()}
    assert status["g1"].is_active is False and status["g2"].is_active is True
    assert json.loads(status["g1"].status_counts) == {"cancelled": 1, "completed": 1, "failed": 1}
    results = {r.run_id: (r.output, r.error) for r in L.collect_results(ledger).collect()}
    assert results["a"] == ("out", None) and results["b"] == (None, "bad") and results["f"] == (None, "No result")
    now = F.lit(datetime(2024, 1, 10))
    outcomes = {r.run_id: (r.outcome, r.message) for r in L.classify(ledger, now, 3 * 86400).collect()}
    assert outcomes["a"][0] == "result" and outcomes["b"] == ("error", "bad") and outcomes["c"] == ("error", "run cancelled")
    assert outcomes["d"][0] == "timeout" and outcomes["e"][0] == "waiting"


def test_cancel(ledger):
    versions = ledger.withColumn("version", F.lit(2))
    older = versions.withColumns({"version": F.lit(1), "status": F.lit("queued")})
    versions = versions.unionByName(older)
    current = L.latest(versions, "run_id", ["version"])
    wanted = ledger.filter("run_id IN ('a', 'd', 'd')").select("run_id").unionByName(ledger.filter("run_id = 'd'").select("run_id"))
    more = L.cancel(current, wanted, "version")
    assert [(r.run_id, r.version, r.status) for r in more.collect()] == [("d", 3, "cancelled")]
    after = L.latest(versions.unionByName(more), "run_id", ["version"])
    found = {r.run_id: (r.version, r.status) for r in after.collect()}
    assert found["d"] == (3, "cancelled") and found["a"] == (2, "completed") and found["e"] == (2, "queued")
    # Cancelling again changes nothing, a version of the caller's choice may be given.
    assert L.cancel(after, wanted, "version").count() == 0
    (row,) = L.cancel(current, wanted, "created_at", F.lit(datetime(2030, 1, 1))).collect()
    assert row.created_at == datetime(2030, 1, 1) and row.version == 2


def test_states_that_end_a_run_win_ties(spark):
    rows = [("a", 1, "running"), ("a", 1, "cancelled"), ("b", 1, "zzz"), ("b", 1, "completed"), ("b", 1, "failed"), ("c", 1, "failed"), ("c", 2, "running")]
    df = spark.createDataFrame(rows, "run_id string, v int, status string")
    assert {r.run_id: r.status for r in L.latest(df, "run_id", ["v"]).collect()} == {"a": "cancelled", "b": "completed", "c": "running"}


def test_submit(ledger):
    queued, summary = L.submit(ledger)
    assert {r.status for r in queued.collect()} == {"queued"}
    assert {r.group_id: r.num_runs for r in summary.collect()} == {"g1": 3, "g2": 3}


def test_memory_checks(spark):
    with pytest.raises(ValueError, match="time zone"):
        M.parse_since("2024-01-01T00:00:00")
    with pytest.raises(ValueError, match="no timestamp"):
        M.parse_since("yesterday")
    assert M.parse_since("2024-01-01T00:00:00Z") == datetime(2024, 1, 1, tzinfo=timezone.utc)
    for bad in ("", "a b", "x" * 129, "ü"):
        with pytest.raises(ValueError):
            M.check_identifier(bad, "scope")
    df = spark.createDataFrame([("s", "task", 1, datetime(2024, 1, 1)), ("s", "monitor", 2, datetime(2024, 1, 3))],
                               "scope string, kind string, id int, updated_at timestamp")
    with pytest.raises(ValueError):
        M.recent(df, 26)
    with pytest.raises(ValueError):
        M.filter_entries(df, kinds=["email"])
    assert [r.id for r in M.filter_entries(df, since="2024-01-02T00:00:00+00:00").collect()] == [2]
    assert [r.id for r in M.filter_entries(df, kinds=["task"], scope="s").collect()] == [1]
    assert [r.id for r in M.recent(df).collect()] == [2, 1]
    with pytest.raises(ValueError):
        M.relevant(df, "x" * 501, "kind")


def test_tier_table(spark):
    tiers = {r.processor: r for r in costs.tiers(spark).collect()}
    assert len(tiers) == 18
    assert (tiers["core2x-fast"].min_seconds, tiers["core2x-fast"].max_seconds) == (15, 180)
    assert (tiers["ultra8x"].min_seconds, tiers["ultra8x"].max_seconds) == (300, 7200)
    assert (tiers["lite"].price_per_row, tiers["pro-fast"].price_per_row, tiers["ultra"].price_per_row) == (0.005, 0.10, None)
