import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tablerich.operators import extract as X
from tablerich.operators import report as R
from tablerich.operators import search as S

SUMMARIES = {
    "# Tin mines of the coast\n\nOutput fell by a third in ten years.\n\n## Wages\n\nThey rose.": "Output fell by a third in ten years.",
    "Rain was scarce in spring.\n\nHarvests came late.\n\n## Prices\n\nUp.": "Rain was scarce in spring.\n\nHarvests came late.",
    "# Ferries\n\nNo part of these words stands below a second heading.": "No part of these words stands below a second heading.",
    "": None,
    "# Ferries\n\nToo few.\n\n## Ports\n\nFour of them.": None,
}


def test_executive_summary(spark):
    df = spark.createDataFrame([(k,) for k in SUMMARIES], "t string").select("t", R.executive_summary(F.col("t")).alias("s"))
    assert {r.t: r.s for r in df.collect()} == SUMMARIES


def test_summary_of_structured_content(spark):
    cases = {
        json.dumps({"text": "# T\n\nA long enough summary here.\n\n## X"}): "A long enough summary here.",
        json.dumps({"summary": "short", "executive_summary": "other"}): "short",
        json.dumps({"executive_summary": "other"}): "other",
        json.dumps({"summary": ""}): None,
        json.dumps({"a": 1}): None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", R.content_summary(F.col("t")).alias("s"))
    assert {r.t: r.s for r in df.collect()} == cases


def test_markdown(spark):
    ladder = "bottom"
    for rung in reversed("pqrstuvw"):
        ladder = {rung: ladder}
    cases = [
        (json.dumps({"text": "only words"}), "only words"),
        (json.dumps({"mean_sea_level": "rising"}), "# Mean Sea Level\n\nrising\n"),
        (json.dumps({"ports": {"north_pier": "open"}}), "# Ports\n\n## North Pier\n\nopen\n\n"),
        (json.dumps({"boats": ["kite", {"crew": "five"}], "knots": 12}), "# Boats\n\n- kite\n## Crew\n\nfive\n\n\n# Knots\n\n12\n"),
        (json.dumps({"none": [], "nil": None, "bare": {}}), "# None\n\n\n# Nil\n\nNone\n\n# Bare\n\n\n"),
        (json.dumps(["ebb", "flow"]), "- ebb\n- flow"),
        (json.dumps([{"tide": "low"}]), "# Tide\n\nlow\n"),
        ("7.5", "7.5"),
        ("false", "False"),
        ("null", ""),
        (None, ""),
        ("not {json", "not {json"),
    ]
    df = spark.createDataFrame(cases, "t string, want string").select("want", R.markdown("t").alias("got"))
    for r in df.collect():
        assert r.got == r.want
    headings = [line for line in R.render(ladder).split("\n") if line.startswith("#")]
    assert headings == [f"{'#' * min(i + 1, 6)} {c.upper()}" for i, c in enumerate("pqrstuvw")]


def test_text_reports(spark):
    cases = [("text", None, "", True), (None, "text", None, True), (None, None, "x", True), (None, None, "", False),
             ("json", "auto", "x", False), (None, None, None, False)]
    df = spark.createDataFrame(cases, "k string, r string, c string, want boolean")
    for r in df.select("want", R.is_text_report(F.col("k"), F.col("r"), F.col("c")).alias("got")).collect():
        assert r.got == r.want


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (1, "Red fox\nred red fox runs", "https://a.example.com/x", "us", "2024-01-02"),
        (2, "Blue dog\nthe fox sleeps", "https://example.org:8080/y", "de", "2024-02-02"),
        (3, "Green cat\nnothing here", "http://notexample.com", "us", None),
    ]
    df = spark.createDataFrame(rows, "id int, text string, url string, country string, day string")
    df = df.withColumn("title", F.split("text", "\n")[0]).withColumn("day", F.col("day").cast("date"))
    return S.Corpus(df, "id", "text", "url", "title", "day", "country")


def test_search(corpus):
    rows = S.search(corpus, objective="red fox").orderBy("rank").collect()
    assert [r.id for r in rows] == [1, 2]
    assert [r.query_no for r in S.search(corpus, queries=["red", "cat"]).orderBy("query_no").collect()] == [1, 2]
    assert [r.id for r in S.search(corpus, queries=["fox"], include_domains=["example.org"]).collect()] == [2]
    assert [r.id for r in S.search(corpus, queries=["fox"], exclude_domains=["example.org"]).collect()] == [1]
    assert [r.id for r in S.search(corpus, queries=["fox", "cat"], after="2024-02-01").collect()] == [2]
    assert [r.id for r in S.search(corpus, queries=["fox"], location="DE").collect()] == [2]
    many = " ".join(f"w{i}" for i in range(40)) + " fox"
    assert {r.id for r in S.search(corpus, queries=[many]).collect()} == {1, 2}


def test_search_checks(corpus):
    with pytest.raises(ValueError, match="mode"):
        S.rank_documents(corpus, ["fox"], mode="slow")
    with pytest.raises(ValueError, match="objective"):
        S.resolve_queries(None, [])
    bare = S.Corpus(corpus.df, "id", "text")
    for policy in ({"after": "2024-01-01"}, {"location": "us"}, {"include_domains": ["a.com"]}):
        with pytest.raises(ValueError, match="names no"):
            S.search(bare, queries=["fox"], **policy)
    with pytest.raises(ValueError, match="5000"):
        S.resolve_queries("x" * 5001, [])
    with pytest.raises(ValueError, match="200"):
        S.check_domains(["a"] * 150, ["b"] * 51)
    with pytest.raises(ValueError, match="1000"):
        S.budget_excerpts(corpus.df, "text", per_result=10)
    with pytest.raises(ValueError, match="600"):
        S.freshness(corpus.df, "day", F.current_date(), 10)


def test_hosts_match_by_suffix_only(corpus):
    got = S.domain_policy(corpus.df, "url", ["example.com"]).collect()
    assert [r.id for r in got] == [1]


def test_markdown_of_pages(spark):
    html = (
        "<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>x<y</script><h1 class='t'>Top</h1>"
        "<p>One&nbsp;two <b>bold</b>.</p><!-- no --><ul><li>first<li>second</ul><h6>Low</h6>1 &lt; 2</body></html>"
    )
    df = spark.createDataFrame([(html,)], "h string")
    row = df.select(X.to_markdown(F.col("h")).alias("m"), X.title_of(F.col("h")).alias("t")).first()
    assert row.t == "A & B"
    assert row.m == "# Top\nOne two bold.\n- first\n- second\n###### Low\n1 < 2"


def test_extract(spark):
    pages = spark.createDataFrame(
        [("u1", "<title>T</title><p>The fox. A dog! The fox ran.</p>"), ("u2", "<p></p>")], "url string, html string"
    )
    asked = spark.createDataFrame([("u1",), ("u1",), ("u2",), ("u3",)], "url string")
    results, errors = X.extract(asked, pages, keywords=["fox"], full_content=True)
    row = results.collect()
    assert len(row) == 1 and row[0].title == "T" and row[0].excerpts == ["The fox.", "The fox ran."]
    assert row[0].full_content == "The fox. A dog! The fox ran."
    assert {(r.url, r.error_type, r.http_status_code) for r in errors.collect()} == {
        ("u2", "empty_content", 200), ("u3", "not_found", 404),
    }
    assert X.extract(asked, pages, excerpts=False)[0].columns == ["url", "title", "publish_date"]


def test_research(corpus):
    report = R.research(["red fox"], corpus).first()
    assert report.question == "red fox"
    assert [c.source for c in report.citations] == ["https://a.example.com/x", "https://example.org:8080/y"]
    assert list(json.loads(report.content)) == ["source_https://a.example.com/x", "source_https://example.org:8080/y"]


def test_plan_cuts_rows_before_the_shuffle(corpus):
    def steps(of):
        plan = S.rank_keys(of, ["fox", "cat"])._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        return [line for line in plan.split("\n") if any(x in line for x in ("Exchange hashpartitioning(query_no", "WindowGroupLimit", "MapInPandas"))]

    # From the top down: the last cut, the shuffle, and below it the cut of each task.
    unique = steps(replace(corpus, unique=True))
    assert [("Exchange" in x, "Partial" in x) for x in unique] == [(False, False), (True, False), (False, True)]
    repeated = steps(corpus)
    assert "MapInPandas" in repeated[-1] and len([x for x in repeated if "Exchange" in x]) == 2


def test_repeated_keys_do_not_fill_the_limit(spark):
    rows = [("u0", "fox fox fox")] * 10 + [(f"u{i}", "fox " + "and more words " * i) for i in range(1, 10)]
    corpus = S.Corpus(spark.createDataFrame(rows, "url string, content string"), "url", "content")
    found = S.rank_documents(corpus, ["fox"], limit=10).orderBy("rank").collect()
    assert [(r.rank, r.url) for r in found] == [(i + 1, f"u{i}") for i in range(10)]
