import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablerich.llm import packing, token_files, tokens

TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "a\nb\n", "\xa0a\xa0 b", "a\tb c", "it's don't  we'll",
    "<|endoftext|> x", "\x01 a\x01b", "漢字 ünïcode \U0001f600 ẞ", "x" * 5000, "word " * 3000, "a\r\nb", "a b c", " \n a",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokens.default_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library(library, monkeypatch):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choices("ab \n.,é1'", k=rng.randrange(60))) for _ in range(300)]
    for words, step in ((600_000, 1 << 22), (20, 100)):
        monkeypatch.setattr(tokens, "MOST_WORDS", words)
        monkeypatch.setattr(tokens, "_STEP_CHARS", step)
        found = tokens.Encoder(tokens.default_path()).encode_batch(pa.array(texts, pa.string()))
        assert [f.tolist() for f in found] == [library(t) for t in texts]


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 16777215, 16777216, 2**32 - 1], list(range(1000))])
def test_codec(values):
    values = np.array(values, np.uint32)
    control, data = token_files.encode(values)
    assert len(control) == -(-len(values) // 4)
    assert token_files.decode(control, data, len(values)).tolist() == values.tolist()


def test_frequent_ids_take_one_byte():
    ids = np.array([40_000] * 1000 + list(range(300)), np.uint16)
    ranked, control, data = token_files.pack_chunk([ids])
    assert np.frombuffer(ranked, "<u4")[0] == 40_000
    assert len(data) == 1000 + 255 + 2 * 45


@pytest.mark.parametrize("chunk", [5, 1 << 20])
def test_files_read_back(spark, make, library, tmp_path, chunk):
    rows = [(i * 7 % 23, t) for i, t in enumerate(TEXTS)] + [(None, "none"), (3, "again")]
    path = str(tmp_path / "files")
    token_files.write_files(make(rows), path, chunk_ids=chunk)
    found = token_files.read_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] + sorted(d for d, _ in rows if d is not None)
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids) for r in found) == sorted((-1 if d is None else d, [*library(t), 0]) for d, t in rows)


def test_no_files_of_no_documents(spark, make, tmp_path):
    token_files.write_files(make([]), str(tmp_path / "none"))
    assert token_files.read_files(spark, str(tmp_path / "none")).count() == 0


def check_packed(pieces, ids, window):
    by_row = {}
    for p in pieces:
        by_row.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for key, own in by_row.items():
        left = [list(x) for x in ids[key]]
        for p in sorted(own, key=lambda p: p.start):
            raw = bytes(p.ids)
            assert p.ids_crc32 == zlib.crc32(raw) and len(raw) == 4 * p.length
            part = np.frombuffer(raw, "<u4").tolist()
            assert any(x[p.start : p.start + p.length] == part for x in left)
        assert sum(p.length for p in own) == sum(map(len, left))
    assert set(by_row) == set(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and at & (at - 1) == 0


@pytest.mark.parametrize("shard", [300, 1 << 21])
def test_packing(make, library, hard, shard):
    rows = hard + [(100 + i, f"topic{i % 4} " * 9 + f"filler{i}") for i in range(60)]
    ids = {}
    for d, t in rows:
        found = [*library(t), 1]
        ids.setdefault((d, len(found)), []).append(found)
    check_packed(packing.pack(make(rows), window=64, shard_tokens=shard).collect(), ids, 64)
    assert packing.pack(make([])).count() == 0


def test_neighbours_share_windows():
    rng = np.random.default_rng(0)
    tails = [rng.integers(100 * (i % 5), 100 * (i % 5) + 100, 16) for i in range(40)]
    pieces = packing.pack_shard([16] * 40, tails, np.ones(1000, np.float32), 16.0, window=64)
    groups = {}
    for d, _, _, sequence, _ in pieces:
        groups.setdefault(sequence, set()).add(d % 5)
    assert sorted(map(len, groups.values())) == [1] * 10


def brute_scores(runs, asked, idf, mean_length):
    out = []
    for run in runs:
        score = 0.0
        for t in set(asked.tolist()) & set(run.tolist()):
            tf = run.tolist().count(t)
            score += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(run) / mean_length))
        out.append(score)
    return out


def test_scores_against_brute_force():
    rng = np.random.default_rng(4)
    runs = [(300 * rng.random(rng.integers(1, 200)) ** 3).astype(np.uint16) for _ in range(40)]
    idf = 0.1 + rng.random(300)
    index = packing.Index(runs, idf, 100.0)
    for members in (range(40), [3, 7, 11, 30]):
        index.keep(np.array(members))
        for i in (0, 7, 39):
            assert index.scores(i) == pytest.approx(brute_scores([runs[m] for m in members], runs[i], idf, 100.0))


def test_neighbours_by_light_terms_and_by_whole_windows():
    # 30 heavy ids that no other document has, and light ones of the topic.
    idf = np.concatenate([np.full(100, 0.5), np.full(2000, 8.0)]).astype(np.float32)
    topics = [np.concatenate([np.arange(2) + 2 * (i % 5), 100 + 30 * i + np.arange(30)]) for i in range(40)]
    # The topic is in the first window only.
    heads = [np.concatenate([np.full(64, i % 5), 100 + 16 * i + np.arange(16)]) for i in range(40)]
    for ids, each in ((topics, 2), (heads, 4)):
        pieces = packing.pack_shard([len(x) for x in ids], ids, idf, 50.0, window=64)
        groups = {}
        for d, _, length, sequence, _ in pieces:
            if length < 64:
                groups.setdefault(sequence, []).append(d % 5)
        assert {(len(g), len(set(g))) for g in groups.values()} == {(each, 1)}


def test_one_ranking_for_all_chunks(spark, make, library, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    path = str(tmp_path / "files")
    token_files.write_files(make(rows), path, chunk_ids=5)
    counts = np.bincount([i for _, t in rows for i in [*library(t), 0]])
    expected = sorted(((-n, i) for i, n in enumerate(counts.tolist()) if n))
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["n"]) for r in ranks] == [(k, i, -n) for k, (n, i) in enumerate(expected)]
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() > 1 and "ranked" not in chunks.columns


def test_neighbours_of_all_shards_against_brute_force(make, library):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["the", "of", "and"]
    rows = [(i, " ".join(rng.choices(words, range(1, 44), k=rng.randrange(1, 40)))) for i in range(60)] + [(None, None), (None, "the"), (3, "w1 w2")]
    found, places = {}, set()
    for shard in (100, 1 << 21):
        got = packing.neighbours(make(rows).coalesce(1), 5, shard_tokens=shard).collect()
        near = {}
        for r in got:
            near.setdefault(r.place, []).append((-r.score, r.near))
            places |= {r.place, r.near}
        found[shard] = {p: [pytest.approx(s, rel=1e-5) for s, _ in sorted(v)] for p, v in near.items()}
    assert found[100] == {p: [x.expected for x in v] for p, v in found[1 << 21].items()}
    ids = [np.array([*library(t), 1]) for _, t in rows]
    df = np.bincount(np.concatenate([np.unique(i) for i in ids]), minlength=60_000)
    idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
    mean = float(np.mean([len(i) for i in ids]))
    best = []
    for i, asked in enumerate(ids):
        scores = [s for j, s in enumerate(brute_scores(ids, asked, idf, mean)) if j != i]
        best.append(sorted(round(-s, 4) for s in scores if s > 0)[:5])
    got = [sorted(x.expected for x in found[1 << 21].get(p, [])) for p in sorted(places)]
    assert len(got) == len(best)
    for a, b in zip(sorted(got), sorted(best)):
        assert a == pytest.approx(b, abs=1e-3)


def test_shards_by_heaviest_term():
    # Copies meet, light terms share a shard, a heavy one has several.
    assert packing.dealt_terms([(1, 5), (3, 5), (7, 25), (8, 2), (9, 9)], 10) == [(1, 0, 1), (3, 0, 1), (7, 1, 3), (8, 4, 1), (9, 5, 1)]
    ids, bounds = np.array([5, 5, 9, 1, 1, 100, 2, 2, 2, 1], np.uint16), np.array([0, 4, 5, 10])
    df, heavy = packing._terms(ids, bounds, 200)
    assert heavy.tolist() == [5, 1, 100] and df[1] == 3 and df[2] == 1 and df.sum() == 7


def test_repeated_rows_are_spread_over_shards(make, library):
    rows = [(None, "same text of some words " * 5)] * 40 + [(7, "another")]
    pieces = packing.pack(make(rows), window=64, shard_tokens=200).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) > 5
    assert sum(p.length for p in pieces) == sum(len(library(t)) + 1 for _, t in rows)
