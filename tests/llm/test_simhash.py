import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tablerich.llm import components, simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    found = sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))
    return found - (1 << 64) if found >> 63 else found


def test_fingerprints(hard, spark):
    for _, text in hard:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    # Spark's own hash of a text has the same seed.
    word = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert word % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_every_close_pair_is_connected(spark):
    rng = random.Random(4)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base:
        for flips in (1, 2, 3, 4, 5, 3, 3):
            fps.add(b ^ sum(1 << x for x in rng.sample(range(64), flips)))
    # A chain, and many within a few bits.
    chain = [base[0] ^ ((1 << 3 * i) - 1) for i in range(1, 15)]
    fps |= set(chain) | {base[1] ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(30), 2)}
    fps = sorted(signed(f) for f in fps)
    links = [(r.a, r.b) for r in simhash.linked(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    assert all(bin((a ^ b) % 2**64).count("1") <= 3 for a, b in links)

    def parts(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(f) for f in fps]

    close = [(a, b) for a, b in itertools.combinations(fps, 2) if bin((a ^ b) % 2**64).count("1") <= 3]
    assert parts(links) == parts(close)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(1)
    if shape == "path":
        order = rng.sample(range(200), 200)
        pairs = list(zip(order, order[1:]))
    elif shape == "star":
        pairs = [(7, i) for i in range(300)]
    else:
        pairs = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_documents(make, hard):
    found = {}
    for r in simhash.near_duplicates(make(hard)).collect():
        found.setdefault(r.doc_id, set()).add(r.component_id)
    assert found[3] == found[4] == found[5] == {3}
    assert found[1] == found[2] == {1}
    assert found[None] == found[7] == {7}
    kept = [r.doc_id for r in simhash.representatives(make(hard)).collect()]
    # The row without a doc_id is a copy of document 7.
    assert sorted(kept) == sorted({c for cs in found.values() for c in cs})


def test_rows_without_identifier_are_deduplicated_too(make):
    one, two = "some text of a few words that stands alone", "quite another one with different words in it altogether"
    rows = [(None, one), (None, one), (None, one + "  "), (None, two), (5, two), (None, ""), (None, None)]
    got = sorted(((r.doc_id, r.text) for r in simhash.representatives(make(rows)).collect()), key=repr)
    assert got == sorted([(5, two), (None, None), (None, one)], key=repr)


def test_repeated_identifiers_are_one_document(make):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (2, "g h i j k l"), (3, "q r s t u v")]
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(make(rows)).collect()}
    assert found == {(1, 1), (2, 1), (3, 3)}
    assert sorted(r.doc_id for r in simhash.representatives(make(rows)).collect()) == [1, 3]


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.representatives(make([])).count() == 0


def test_rows_without_identifier_link_others(spark, make, monkeypatch):
    # Two bits apart each: 1 and 2 only meet by way of rows without a doc_id; 3 is alone, as is one without any named neighbour.
    rows = [(1, 0b000011), (None, 0b001111), (None, 0b001111), (2, 0b111111), (3, 0xFF << 40), (None, 0xFF << 20)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: spark.createDataFrame(rows, "doc_id long, fp long"))
    found = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(None).collect()), key=repr)
    component = {0b000011: 1, 0b001111: 1, 0b111111: 1, 0xFF << 40: 3, 0xFF << 20: None}
    assert found == sorted(((d, fp, component[fp]) for d, fp in rows), key=repr)
