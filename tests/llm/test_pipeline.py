import collections
import random

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tablerich.llm import catalog, quality, simhash
from tests.llm.test_exact import brute as equal_texts


def test_every_operator_and_the_pipeline_are_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(catalog.QUERIES) | {"pipeline"} <= names
    assert set(oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, sf, name):
    from tests.oracle import compare

    problem, rows, _ = compare(spark, duck, sf, catalog.QUERIES[name], catalog.ORACLE[name])
    assert problem is None and rows > 0


@pytest.fixture(scope="module")
def folder(spark, make, tmp_path_factory):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(500)]
    rows = []
    for i in range(240):
        text = ". ".join(" ".join(rng.choices(words, k=12)) for _ in range(10)) if i % 6 else "BUY NOW!! " * (20 + i)
        rows.append((i, text, f"src{i % 3}"))
    rows += [(300 + i, rows[i][1] + " ", rows[i][2]) for i in range(1, 20)]
    path = tmp_path_factory.mktemp("corpus")
    make(rows, clash=False).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 6 > 0), 0) for i in range(0, 240) if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, folder)
    rows = [tuple(r) for r in good.select("doc_id", "text").collect()]
    scores = {r.doc_id: r.score for r in quality.score(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert sorted(d for d, _ in rows) == sorted(d for d, s in scores.items() if s >= quality.THRESHOLD)
    assert not any("BUY" in t for _, t in rows) and len(rows) >= 200
    once = stages["exact dedup"](spark, good, folder)
    assert sorted(r.doc_id for r in once.collect()) == sorted(d for d, _, _, kept, _ in equal_texts(rows) if kept)
    near = stages["simhash near-dedup"](spark, once, folder)
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in once.collect()}
    lonely = [d for d in fps if not any(e != d and bin((fps[e] ^ fps[d]) % 2**64).count("1") <= 3 for e in fps)]
    assert set(lonely) <= {r.doc_id for r in near.collect()}
    mixed = stages["mixing"](spark, near, folder)
    assert [x.columns for x in (good, once, near, mixed)] == [columns] * 4
    words = sum(len(r.text.split()) for r in near.collect())
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - words) <= 3
    packed = stages["packing"](spark, mixed, folder).collect()
    sizes = collections.Counter()
    for p in packed:
        sizes[p.sequence_id] += p.length
    assert all(s & (s - 1) == 0 and s <= 2048 for s in sizes.values())
    assert {p.doc_id for p in packed} == {r.doc_id for r in mixed.collect()}


def test_run_is_the_stages_in_order(spark, folder):
    rows = [tuple(r) for r in corpus_pipeline.run(spark, folder).drop("ids").collect()]
    again = [tuple(r) for r in corpus_pipeline.run(spark, folder).drop("ids").collect()]
    assert sorted(rows) == sorted(again) and rows


@pytest.mark.parametrize("documents", [0, 1, 400])
def test_run_on_hard_rows_and_empty_tables(spark, make, hard, tmp_path, documents):
    rows = []
    if documents > 1:
        rng = random.Random(5)
        words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(300)]
        rows = [(i, ". ".join(" ".join(rng.choices(words, k=12)) for _ in range(6)), f"src{i % 3}") for i in range(20, 200)]
        rows += [(None, t, None) for _, t, _ in rows[:3]] + [(None, None, None), (None, "", "src1"), (21, rows[1][1], "src1")] + hard
    elif documents:
        rows = [(None, None, None)]
    path = str(tmp_path)
    make(rows, clash=False).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 > 0), 0) for i in range(20, 120) if documents > 1]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pieces = corpus_pipeline.run(spark, path).collect()
    sizes = collections.Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    assert all(n & (n - 1) == 0 and n <= 2048 for n in sizes.values())
    assert bool(pieces) or documents < 2
