import random

import pytest
from pyspark.sql import functions as F

from tablerich.operators import index as I
from tablerich.operators import search as S

WORDS = "red fox dog the a sleeps runs über green blue cat house".split()


def texts(seed, n, first=0):
    rng = random.Random(seed)
    rows = [(first + i, " ".join(rng.choices(WORDS, range(1, len(WORDS) + 1), k=rng.randrange(40)))) for i in range(n)]
    return [*rows, (first + n, None), (first + n + 1, ""), (first + n + 2, "the the The!")]


def corpus(spark, rows, **options):
    return S.Corpus(spark.createDataFrame(rows, "id int, text string").selectExpr("*", "'x' AS row", "1 AS term", "2 AS block").repartition(3), "id", "text", **options)


QUERIES = ["red fox", "the dog über", "nothing at all", "cat", "", "green house sleeps"]


def same(index, of, limit):
    got = sorted(map(tuple, index.rank_keys(QUERIES, limit=limit).collect()))
    assert got == sorted(map(tuple, S.rank_keys(of, QUERIES, limit=limit).collect())) and got


@pytest.mark.parametrize("unique", [True, False])
def test_stored_index_finds_what_the_scan_does(spark, tmp_path, unique):
    rows = texts(1, 300)
    # Rows that share a key: the best of them counts.
    rows += [] if unique else [(i, t) for i, (_, t) in zip(range(0, 90, 3), texts(2, 27))]
    of = corpus(spark, rows, unique=unique)
    index = I.StoredIndex.build(of, str(tmp_path / "index"))
    for limit in (1, 7, 1000):
        same(index, of, limit)


def test_text_is_not_read_by_a_search(spark, tmp_path):
    corpus(spark, texts(1, 60)).df.write.parquet(str(tmp_path / "corpus"))
    index = I.StoredIndex.build(S.Corpus(spark.read.parquet(str(tmp_path / "corpus")), "id", "text", unique=True), str(tmp_path / "index"))
    scans = [x for x in index.rank_keys(QUERIES)._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert scans and all("/corpus" not in x for x in scans)


def test_blocks_that_cannot_enter_are_skipped(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(WORDS[:6], k=30)) + f" rare{i}" * (i % 97 == 0)) for i in range(9000)]
    of = S.Corpus(spark.createDataFrame(rows, "id int, text string").repartition(2), "id", "text", unique=True)
    index = I.StoredIndex.build(of, str(tmp_path / "index"))
    asked = spark.createDataFrame([(i, f"the fox rare{97 * i}") for i in range(20)], "q int, t string")
    found, bounds, waves = index.ranked(asked, "q", "t", limit=1, waves=(4,))
    assert [r.id for r in found.orderBy("q").collect()] == [97 * i for i in range(20)]
    # Of over a hundred blocks for each query few are scored.
    assert bounds.count() > 20 * 100
    assert waves[0].count() == 80 and waves[1].count() < 200
    most, exact = bounds.groupBy("_q").agg(F.max("bound").alias("b")), found.select("q", "score")
    assert most.join(exact, F.col("_q") == F.col("q")).filter("b < score").count() == 0


def test_a_frequent_word_is_split(spark, tmp_path, many_parts):
    rows = [(i, "the") for i in range(5000)]
    index = I.StoredIndex.build(corpus(spark, rows, unique=True), str(tmp_path / "index"))
    held = spark.read.parquet(f"{index.path}/blocks").filter("term = 'the'")
    assert held.agg(F.max("n")).first()[0] <= I.BLOCK
    assert held.select(F.input_file_name()).distinct().count() > 1


def test_segments_tombstones_and_compaction(spark, tmp_path):
    first, second, third = texts(1, 200), texts(2, 60, 1000), texts(3, 30, 2000)
    index = I.StoredIndex.build(corpus(spark, first, unique=True), str(tmp_path / "index"))
    before = {f for f in map(str, (tmp_path / "index").rglob("*.parquet"))}
    assert index.add(corpus(spark, second).df, "text") == 1
    added = [f for f in map(str, (tmp_path / "index").rglob("*.parquet")) if f not in before]
    # The words of the new documents and no others were written.
    assert added and all("segment=1" in f for f in added)
    rows = first + second
    same(index, corpus(spark, rows, unique=True), 9)
    gone = [i for i, _ in rows if i % 3 == 0]
    index.remove(spark.createDataFrame([(i,) for i in gone + gone[:5] + [77777]], "id int"))
    rows = [r for r in rows if r[0] not in set(gone)]
    same(index, corpus(spark, rows, unique=True), 9)
    index.add(corpus(spark, third).df, "text")
    index.remove(spark.createDataFrame([(1001,), (2001,), (1,)], "id int"))
    rows = [r for r in rows + third if r[0] not in (1001, 2001, 1)]
    same(index, corpus(spark, rows, unique=True), 9)
    index.compact()
    assert [(s, d) for s, d, _ in index.segments()] == [(3, len(rows))]
    same(index, corpus(spark, rows, unique=True), 9)
    # A removed document may come back.
    index.add(spark.createDataFrame([(1, "red fox again")], "id int, text string"), "text")
    same(index, corpus(spark, [*rows, (1, "red fox again")], unique=True), 9)


def test_a_write_without_totals_does_not_count(spark, tmp_path):
    of = corpus(spark, texts(1, 50), unique=True)
    index = I.StoredIndex.build(of, str(tmp_path / "index"))
    for name in ("documents", "blocks"):
        spark.read.parquet(f"{index.path}/{name}/segment=0").write.parquet(f"{index.path}/{name}/segment=1")
    same(index, of, 9)
    index.add(corpus(spark, texts(2, 20, 500)).df, "text")
    same(index, corpus(spark, texts(1, 50) + texts(2, 20, 500), unique=True), 9)


def test_memory_on_an_index(spark, tmp_path):
    from tablerich.operators import memory as M

    rows = [(f"s{i % 5}", "task" if i % 2 else "monitor", i, i, text) for i, text in texts(6, 80)]
    schema = "scope string, kind string, id int, updated_at int, text string"
    frame = lambda some: spark.createDataFrame(some, schema)
    kept = M.MemoryIndex.build(frame(rows[:50]), "text", str(tmp_path / "memory"))
    kept.add(frame(rows[50:]), "text")
    gone = frame(rows[:30:4])
    cleared = spark.createDataFrame([("s1", 40), ("s1", 21), ("s2", 7), ("none", 99)], "scope string, cleared_at int")
    kept.evict(gone)
    kept.clear(cleared)
    live = M.clear(M.evict(frame(rows), gone), cleared)
    assert 20 < live.count() < 70
    for _ in range(2):
        expected = M.relevant(live, "red fox über", "text", 25).select("scope", "kind", "id", "score", "rank")
        got = kept.relevant("red fox über", 25).select(*expected.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
        kept.compact()
    with pytest.raises(ValueError):
        kept.relevant("fox", 26)


def test_empty_corpus(spark, tmp_path):
    index = I.StoredIndex.build(corpus(spark, [], unique=True), str(tmp_path / "index"))
    assert index.rank_keys(["fox"]).count() == 0
    with pytest.raises(ValueError):
        index.rank_keys(["fox"], limit=0)


def test_steps_are_whole_blocks_of_few_words(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    rng = random.Random(6)
    sizes = [rng.randrange(40) for _ in range(1000)]
    sizes[300] = 5000
    whole = pa.RecordBatch.from_pydict({"id": list(range(1000)), "_w": [["w"] * n for n in sizes]}).slice(7)
    parts = list(I._steps(whole, "_w", 4000))
    assert [i for p in parts for i in p.column("id").to_pylist()] == list(range(7, 1000))
    assert all(p.num_rows % I.BLOCK == 0 for p in parts[:-1])
    assert all(len(p.column("_w").flatten()) <= 4000 or p.num_rows <= I.BLOCK for p in parts) and 4 < len(parts) < 10
    # The index is the same, whatever the step.
    of = corpus(spark, texts(1, 900), unique=True)
    columns = ["term", "block", "place", "tf", "len", "n", "most_tf", "least_len"]
    stored = []
    for step in (I.STEP, 100):
        monkeypatch.setattr(I, "STEP", step)
        index = I.StoredIndex.build(of, str(tmp_path / f"index{step}"))
        stored.append([sorted(map(repr, spark.read.parquet(f"{index.path}/{t}").select(*c).collect())) for t, c in (("blocks", columns), ("documents", ["row", "id", "words"]))])
        same(index, of, 7)
    assert stored[0] == stored[1] and len(stored[0][1]) == 903
