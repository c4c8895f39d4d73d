import pytest

from __spark_entry__ import entry
from tablerich.plans import catalog
from tests.oracle import compare

QUERIES, SQL = catalog.load()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    problem, rows, _ = compare(spark, duck, sf, QUERIES[name], SQL.get(name))
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", ["batch_ids", "batch_slice", "extract_full", "run_progress", "change_events", "stream_changes"])
def test_ordered_queries_across_partitions(spark, duck, sf, many_parts, name):
    problem, _, _ = compare(spark, duck, sf, QUERIES[name], SQL[name])
    assert problem is None


@pytest.mark.parametrize(
    "name", ["monitor_list", "monitor_schedule", "search_after_date", "freshness_policy", "typed_outputs", "stream_windowed"]
)
def test_zone_of_the_session_does_not_matter(spark, duck, sf, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        problem, _, _ = compare(spark, duck, sf, QUERIES[name], SQL[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert problem is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_is_lazy_and_has_a_schema(spark):
    df = entry(spark)
    assert df.columns[-3:] == ["country_name", "region_name", "order_volume"]
    assert df.count() > 0
