import collections

import numpy as np
import pytest

from tablerich.llm import mixing


def test_targets():
    found = mixing.targets({"b": 100, "a": 100, None: 10, "c": 0}, (5, 2, 1))
    # a weighs 5, b 2, c 1 (nothing to give), the null source 5 again, at most 3 times its size.
    assert found["c"] == 0 and found[None] == 30
    assert found["a"] + found["b"] == pytest.approx(180)
    assert found["a"] / found["b"] == pytest.approx(2.5)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    index = np.arange(n)
    found = mixing.permute(index, n, 5)
    assert sorted(found) == list(range(n))
    assert (mixing.permute(found, n, 5, inverse=True) == index).all()


@pytest.mark.parametrize("quotas", [[5, 0, 300, 41], [1], [64, 64], [10**9, 3 * 10**9 + 7]])
def test_shard_counts_add_up(quotas):
    per = 64 if sum(quotas) < 10_000 else sum(quotas) // 20
    shards = -(-sum(quotas) // per)
    total = [0] * len(quotas)
    for s in range(shards):
        before, here = mixing.shard_counts(quotas, per, s, 1)
        assert before == total
        assert sum(here) == min(per, sum(quotas) - s * per)
        total = [a + b for a, b in zip(total, here)]
    assert total == quotas


@pytest.mark.parametrize("size, take", [(1000, 0), (1000, 1), (1000, 999), (1000, 1000), (1000, 3000), (5, 7), (64, 130), (1001, 1500)])
def test_a_source_gives_what_it_should(size, take):
    for seed in range(5):
        s = mixing.Source("x", 3, size, take, 64, seed)
        epoch, block, words = s.blocks_of(np.arange(s.slots)) if s.slots else (np.zeros(0),) * 3
        assert words.sum() == take
        assert len(set(zip(epoch, block))) == s.slots and (words > 0).all()


ROWS = [(i, "w%d " % i * (i % 40), ["a", "a", "a", "b", None][i % 5]) for i in range(300)] + [
    (1000, None, "b"), (1001, "", "a"), (1002, " one\n two  three", "tiny"), (5, "w5 " * 5, "a"), (5, "w5 " * 5, "a"), (None, "x y", "b"),
]


def test_report(make):
    sizes = collections.Counter()
    for _, text, source in ROWS:
        sizes[source] += len((text or "").split())
    target = mixing.targets(dict(sizes), (5, 2, 1))
    runs = [sorted((tuple(r) for r in mixing.Mix(make(ROWS), block_words=16, shard_slots=8).report().collect()), key=repr) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == len(ROWS)
    taken = collections.Counter()
    by_row = collections.Counter((d, len((t or "").split())) for d, t, _ in ROWS)
    assert collections.Counter((d, n) for d, n, *_ in runs[0]) == by_row
    for _, size, source_size, t, n in runs[0]:
        assert n <= 3 * size
        taken[source_size, round(t, 6)] += n
    for source, t in target.items():
        assert abs(taken[sizes[source], round(t, 6)] - t) <= 1


def test_documents(make):
    mix = mixing.Mix(make(ROWS), block_words=16, shard_slots=8)
    docs = make(ROWS)
    found = mixing.Mix(docs, block_words=16, shard_slots=8).documents()
    assert found.columns == docs.columns
    got = collections.Counter()
    for r in found.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(r.text.split())
    expected = collections.Counter()
    for r in mix.report().collect():
        expected[r.doc_id] += r.taken
    assert got == +expected


def test_empty_tables(make):
    assert mixing.Mix(make([])).report().count() == 0
    assert mixing.Mix(make([])).documents().count() == 0
    nothing = mixing.Mix(make([(1, None), (2, " ")]))
    assert [r.taken for r in nothing.report().collect()] == [0, 0]
