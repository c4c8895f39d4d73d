from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablerich.operators import monitor as M
from tablerich.operators.resolvers import CallableResolver
from tablerich.streaming import changes as C
from tablerich.streaming import enrichment as ST


def test_registry_checks():
    with pytest.raises(ValueError, match="query"):
        M.new_monitor("event_stream", frequency="daily")
    with pytest.raises(ValueError, match="task run"):
        M.new_monitor("snapshot", frequency="daily")
    with pytest.raises(ValueError):
        M.new_monitor("other", frequency="daily")
    assert M.new_monitor("event_stream", frequency="weekly", query="q")["frequency"] == "1w"
    with pytest.raises(ValueError, match="nothing"):
        M.monitor_update(frequency=None)
    with pytest.raises(ValueError, match="query"):
        M.monitor_update(query="new")
    assert M.monitor_update(frequency="every_two_weeks") == {"frequency": "2w"}


@pytest.mark.parametrize("bad", ["0h", "31d", "5w", "721h", "h", "1m", "", "yearly"])
def test_bad_frequencies(spark, bad):
    with pytest.raises(ValueError):
        M.check_frequency(bad)
    assert spark.range(1).select(M.frequency_hours(F.lit(bad)).alias("h")).first().h is None


def test_frequencies(spark):
    cases = {"hourly": 1, "daily": 24, "weekly": 168, "every_two_weeks": 336, "1h": 1, "30d": 720, "4w": 672}
    df = spark.createDataFrame([(k,) for k in cases], "f string").select("f", M.frequency_hours(F.col("f")).alias("h"))
    assert {r.f: r.h for r in df.collect()} == cases


def test_updates_and_sticky_cancel(spark):
    rows = [("m", 1, "event_stream", "1h", "x", "active"), ("m", 2, None, None, "y", "cancelled"), ("m", 3, None, "1d", None, "active")]
    df = spark.createDataFrame(rows, "id string, v int, type string, frequency string, metadata string, status string")
    row = M.current_monitors(df, "id", ["v"], ["type"], ["frequency", "metadata"]).first()
    assert (row.type, row.frequency, row.metadata, row.status) == ("event_stream", "1h", "y", "cancelled")


def test_pages_walk_the_whole_list(spark):
    df = spark.range(25).selectExpr("id", "id div 4 AS created_at", "'active' AS status", "'snapshot' AS type")
    seen, cursor = [], None
    while True:
        seen += [r.id for r in M.list_monitors(df, "id", limit=7, cursor=cursor).collect()]
        cursor = M.next_cursor(df, ["created_at", "id"], 7, cursor)
        if cursor is None:
            break
    assert seen == list(range(24, -1, -1))
    with pytest.raises(ValueError):
        M.page(df, ["id"], 0)
    with pytest.raises(ValueError):
        M.list_events(df, ["id"], limit=101)


def test_event_summaries(spark):
    long = "x" * 60
    rows = [
        ("event_stream", "g", "e", "d", None, f'{{"content":"{long}"}}', None, None),
        ("event_stream", "", "e", "d", None, "plain", None, None),
        ("snapshot", "g", "e", "d", None, None, '{"content":""}', None),
        ("completion", "g", "e", "d", "t", None, None, None),
        ("error", "g", "e", "d", "t", None, None, "broken"),
        ("other", "g", "e", "d", "t", None, None, None),
    ]
    names = "event_type event_group_id event_id event_date timestamp output changed_output error_message"
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    assert [tuple(r) for r in M.event_summary(df).collect()] == [
        ("event_stream", "g", "d", "x" * 50),
        ("event_stream", "e", "d", "plain"),
        ("snapshot", "g", "d", "fields changed"),
        ("completion", "", "t", "Run completed (no change)"),
        ("error", "", "t", "broken"),
        ("other", "", "", ""),
    ]


def events(spark, n=400):
    start = datetime(2024, 1, 1)
    rows = [(i, 1 if i % 3 == 0 else i % 7, start + timedelta(minutes=i), "abc"[(i * i // 5) % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, state string")


def test_backfill_and_completions(spark):
    df = events(spark)
    changes = M.change_events(df, "k", ["ts", "id"], "state").count()
    keys = df.select("k").distinct().count()
    assert M.change_events(df, "k", ["ts", "id"], "state", backfill=True).count() == changes + keys
    every = M.change_events(df, "k", ["ts", "id"], "state", completions=True)
    assert every.count() == 400
    assert every.filter("event_type = 'completion'").count() == 400 - changes


def run_changes(spark, source, path, schema, **options):
    stream = C.state_session(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    found = C.detect_changes(stream, "k", ["ts", "id"], "state", **options)
    query = (
        found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/cp")
        .trigger(availableNow=True).start(f"{path}/out")
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("options", [{}, {"backfill": True}, {"completions": True}])
def test_stream_of_many_batches_equals_batch(spark, tmp_path, options):
    df = events(spark)
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(4):
        df.filter(F.col("id").between(part * 100, part * 100 + 99)).coalesce(1).write.mode("append").parquet(source)
    run_changes(spark, source, path, df.schema, **options)
    columns = ["id", "k", "state", "previous", "event_type"]
    got = sorted(map(str, C.read_changes(spark, f"{path}/out").select(*columns).collect()))
    want = sorted(map(str, M.change_events(df, "k", ["ts", "id"], "state", **options).select(*columns).collect()))
    assert got == want
    # The session of the caller is as it was.
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_late_rows_change_nothing_and_state_is_written_for_touched_keys(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, k long, ts long, state string"
    rows = lambda *r: spark.createDataFrame(list(r), schema).coalesce(1).write.mode("append").parquet(source)
    rows(*[(i, i, 0, "a") for i in range(500)], (999, None, 0, "n"))
    run_changes(spark, source, path, schema)
    rows((1000, 7, 1, "b"), (1001, 7, -1, "late"), (1002, 900, 1, "new"), (1003, None, 2, None))
    query = run_changes(spark, source, path, schema)
    state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]][-1]
    # Of 502 keys those of the batch are written.
    assert 0 < state["numRowsUpdated"] <= 4
    rows((2000, 7, 2, "c"))
    run_changes(spark, source, path, schema)
    got = sorted((r.id, r.state, r.previous) for r in C.read_changes(spark, f"{path}/out").collect())
    assert got == [(1000, "b", "a"), (1003, None, "n"), (2000, "c", "b")]
    assert [r.id for r in C.read_late(spark, f"{path}/out").collect()] == [1001]


def test_keys_expire_in_event_time(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, k long, ts timestamp_ntz, state string"
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    options = {"backfill": True, "event_time": "ts", "delay": "1 minute", "expire_after": 600}
    for batch in ([(1, 1, at(0), "a"), (2, 2, at(0), "a")], [(3, 2, at(5), "b")], [(4, 3, at(14), "x")], [(5, 1, at(15), "a"), (6, 2, at(15), "b")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        run_changes(spark, source, path, schema, **options)
    found = {r.id: r.event_type for r in C.read_changes(spark, f"{path}/out").collect()}
    # Key 1 was silent for more than ten minutes and begins anew; key 2 was not and has not changed.
    assert found == {1: "event_stream", 2: "event_stream", 3: "event_stream", 4: "event_stream", 5: "event_stream"}
    with pytest.raises(ValueError):
        C.detect_changes(spark.createDataFrame([], schema), "k", ["ts"], "state", expire_after=5)


def test_processing_time_trigger(spark, tmp_path):
    import time

    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    df = events(spark, 40)
    df.limit(20).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    stamp = lambda rows, n: [{"upper": r["s"].upper()} for r in rows]
    found = ST.enrich_stream(stream, {"s": "state"}, ["Upper"], CallableResolver(stamp))
    query = ST.start_stream(found, f"{path}/out", f"{path}/cp", every="1 second")
    try:
        df.subtract(spark.read.parquet(source)).coalesce(1).write.mode("append").parquet(source)
        deadline = time.time() + 60
        while time.time() < deadline and sum(p["numInputRows"] for p in query.recentProgress) < 40:
            time.sleep(0.2)
    finally:
        query.stop()
    assert spark.read.parquet(f"{path}/out").count() == 40
    with pytest.raises(ValueError):
        ST.start_stream(found, path, path, every="1 second", once=True)


def test_batch_sink_can_run_again(spark, tmp_path):
    path = str(tmp_path / "sink")
    enrich = ST.batch_enricher({"s": "state"}, ["Upper"], CallableResolver(lambda rows, n: [{"upper": r["s"].upper()} for r in rows]))
    write = ST.batch_writer(path, enrich)
    for _ in range(2):
        write(events(spark, 10), 0)
    write(events(spark, 5), 1)
    out = spark.read.parquet(path)
    assert out.count() == 15
    assert out.filter("enriched_data LIKE '{\"upper\":\"%'").count() == 15


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    source = str(tmp_path / "in")
    df = events(spark)
    df.coalesce(1).write.parquet(source)
    stream = ST.first_per_key(spark.readStream.schema(df.schema).parquet(source), "ts", ["k"], "10 minutes")
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_progress_listener(spark, tmp_path):
    seen = []

    def note(batch, rows, observed):
        seen.append(rows)
        raise RuntimeError("ignored")

    listener = ST.ProgressListener(note)
    spark.streams.addListener(listener)
    try:
        df = events(spark, 10)
        df.write.parquet(str(tmp_path / "in"))
        query = (
            spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).writeStream.format("noop")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        import time

        for _ in range(50):
            if seen:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(seen) == 10
