import random
import zlib

import pytest

from tablerich.llm import quality


@pytest.fixture(scope="module")
def corpus():
    """Prose of label 1, and junk of two kinds of label 0; not all are labelled."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(400)]
    rows, labels = [], []
    for i in range(500):
        if i % 6:
            text, good = ". ".join(" ".join(rng.choices(words, k=rng.randrange(6, 15))) for _ in range(8)), 1
        elif i % 12:
            text, good = "BUY NOW!! " * rng.randrange(20, 90), 0
        else:
            text, good = " | ".join(rng.choices(words[:5], k=100)), 0
        rows.append((i, text))
        if i % 10 < 8:
            labels.append((i, good, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, make, corpus):
    rows, labels = corpus
    table = spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in quality.score(make(rows), table).collect()}
    assert len(found) == len(rows)
    held = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    truth = {i: q for i, q, _ in labels}
    right = [(found[i].score >= quality.THRESHOLD) == truth[i] for i in held]
    assert sum(right) / len(right) > 0.97
    again = {r.doc_id: r.score for r in quality.score(make(rows), table).collect()}
    assert all(again[i] == pytest.approx(found[i].score, abs=1e-9) for i in again)


def test_held_out_labels_are_not_read(spark, make, corpus):
    rows, labels = corpus
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (
        {r.doc_id: r.score for r in quality.score(make(rows), spark.createDataFrame(x, LABELS)).collect()} for x in (labels, turned)
    )
    assert a == pytest.approx(b, abs=1e-9)


def test_accepted_keeps_rows_whole(spark, make, corpus):
    rows, labels = corpus
    docs = make(rows)
    kept = quality.accepted(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    truth = {i: q for i, q, _ in labels}
    got = {r.doc_id for r in kept.collect()}
    assert sum(i in got for i in truth if truth[i]) / sum(truth.values()) > 0.97
    assert sum(i in got for i in truth if not truth[i]) <= 2


def test_hard_rows(spark, make, hard):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, None, 0), (None, 1, 0), (9, 0, 0), (1, 1, 0)], LABELS)
    found = quality.score(make(hard), labels).collect()
    assert len(found) == len(hard) and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    none = quality.score(make(hard), labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score(make([]), labels).count() == 0
    assert quality.accepted(make([]), labels).count() == 0


def test_sample_is_bounded_by_rows(spark, make, corpus, monkeypatch):
    rows, labels = corpus
    # Two thirds of the rows have no or the same identifier, some of them are equal.
    rows = rows[:200] + [(None, f"{t} {i % 150}") for i, t in rows[:200]] + [(1, t) for _, t in rows[:100]] + [(None, "equal")] * 100
    seen = []
    monkeypatch.setattr(quality, "train", lambda positive, unlabelled, *a, **k: seen.append((len(positive), len(unlabelled))))
    quality.fit(make(rows), spark.createDataFrame(labels, LABELS), most_positive=30, most_unlabelled=120)
    (positive, unlabelled), = seen
    assert 0 < positive <= 30 and 60 < unlabelled <= 120
