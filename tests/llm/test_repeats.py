import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tablerich.llm import repeats, substrings, suffix_array

LAST = (1 << 63) - 1


def brute_bytes(rows, window):
    order = lambda d: LAST if d is None else d
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - window + 1):
            w = b[i : i + window]
            first[w] = min(first.get(w, LAST), order(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < order(d):
                gone[i : i + window] = True
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_words(rows, window):
    order = lambda d: LAST if d is None else d
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, LAST), order(d))
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(d):
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(seed, n=60):
    """Documents of few words with shared passages, some at their edges, and a passage that most hold."""
    rng = random.Random(seed)
    words = ["ab", "c", "the", "ünd", "of", "longerword", "x1"]
    passages = [" ".join(rng.choices(words, k=rng.randrange(5, 40))) for _ in range(8)]
    common = " ".join(rng.choices(words, k=30))
    rows = []
    for d in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(0, 20)))]
        parts += rng.sample(passages, rng.randrange(0, 3))
        if d % 3 == 0:
            parts.append(common)
        rng.shuffle(parts)
        rows.append((d, rng.choice([" ", "\n", "  "]).join(parts)))
    rng.shuffle(rows)
    return rows


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)




@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(make, seed):
    rows = texts(seed)
    found = suffix_array.suffix_array_dedup(make(rows))
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 50)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(make, seed):
    rows = texts(seed)
    found = substrings.substring_dedup(make(rows))
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows, 13)


def test_hard_rows(make, hard):
    small = [(d, t if t is None or len(t) < 1000 else t[:1200]) for d, t in hard]
    found = suffix_array.suffix_array_dedup(make(small))
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(small, 50)
    found = substrings.substring_dedup(make(small))
    assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(small, 13)


def test_empty_table_and_kept_text(make):
    assert suffix_array.suffix_array_dedup(make([])).count() == 0
    assert substrings.substring_dedup(make([])).count() == 0
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, "first " + shared), (2, shared + " second")]
    got = {r.doc_id: bytes(r.kept) for r in substrings.substring_dedup(make(rows), with_text=True).collect()}
    assert got == {1: ("first " + shared).encode(), 2: b"second"}


def test_long_documents_are_cut_into_steps_without_loss(monkeypatch):
    monkeypatch.setattr(repeats, "STEP", 64)
    units = repeats.Bytes(20, 10)
    rng = random.Random(3)
    raw = bytes(rng.choice(b"abc") for _ in range(1000))
    seen = []
    for pieces, owners, sizes, begins in repeats._segments(units, [(7, raw, len(raw))]):
        runs = repeats.runs_of(units, pieces, sizes)
        for p, first, n, place in zip(runs.piece, runs.first, runs.windows, runs.place):
            seen += [int(begins[p] + first + i) for i in range(n)]
            assert 0 <= place - n + 1 and place <= units.window - units.gram
    assert sorted(seen) == list(range(1000 - 20 + 1))


@pytest.mark.parametrize("window", [8, 13, 16, 31, 50, 64])
def test_refinement_tells_windows_apart(window):
    rng = random.Random(window)
    buffer = bytes(rng.choice(b"ab\xff\x00") for _ in range(200)) * 2 + b"ab" * 100
    starts = np.arange(len(buffer) - window + 1)
    ids = suffix_array.refine(buffer, starts, window)
    known = {}
    for s, i in zip(starts, ids):
        assert known.setdefault(int(i), buffer[s : s + window]) == buffer[s : s + window]
    assert len(known) == len({buffer[s : s + window] for s in starts})
    # Ranks are in the order of the suffixes.
    assert [known[i] for i in sorted(known)] == sorted(known.values())


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_subtrees_do_not_depend_on_their_size(size):
    rng = random.Random(5)
    texts_ = [" ".join(rng.choices("ab", k=30)).encode() for _ in range(20)]
    counts = np.full(20, 30 - 6 + 1)
    classes = substrings.classify(texts_, counts, 6, group_size=size)
    windows = [tuple(t.split()[i : i + 6]) for t in texts_ for i in range(25)]
    assert len(set(zip(classes.tolist(), windows))) == len(set(windows)) == len(set(classes.tolist()))


def test_prefix_groups_fit_and_are_whole():
    words = np.random.default_rng(1).integers(0, 3, 500)
    starts = np.arange(480)
    groups = list(substrings.prefix_groups(words, starts, 13, 40))
    assert sorted(np.concatenate(groups).tolist()) == list(range(480))
    assert max(map(len, groups)) <= 40


def widest_bucket(units, rows, parts, hot_runs):
    """The most texts of one key that step 2 sends to a task."""
    batch = pa.RecordBatch.from_pydict({"doc": [d for d, _ in rows], "text": [t for _, t in rows]})
    sent = lambda step, *given: [r for b in step(iter(given)) for r in zip(*(c.to_pylist() for c in b.columns))]
    verdicts = sent(repeats._find_shared(parts, hot_runs), repeats._rows(sent(repeats._send_hashes(units, parts), batch)))
    blocks = verdicts + sent(repeats._send_texts(parts), batch)
    found = {}
    for part in range(parts):
        own = [r for r in blocks if r[1] == part]
        for kind, _, block in sent(repeats._send_runs(units, parts), repeats._rows(own)):
            if kind == repeats.RUNS:
                runs = repeats._unpacked(block)
                for key, _, _ in set(zip(runs["key"].tolist(), runs["place"].tolist(), runs.texts)):
                    found[key] = found.get(key, 0) + 1
    return max(found.values())


def common_line(n):
    rng = random.Random(8)
    line = "licensed under the terms of a licence that everyone copies word by word into every file"
    around = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(15))
    return [(d, f"{around()} {line} {around()}") for d in range(n)]


@pytest.mark.parametrize("units", [repeats.Bytes(50, 24), repeats.Words(13, 5)])
def test_a_common_line_with_different_surroundings_is_split(units):
    assert widest_bucket(units, common_line(400), 4, 50) <= 50


def test_split_buckets_against_brute_force(make, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_RUNS", 4)
    monkeypatch.setattr(repeats, "PART_BYTES", 2000)
    for rows in (texts(3), common_line(60) + [(None, common_line(1)[0][1])]):
        found = suffix_array.suffix_array_dedup(make(rows))
        assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 50)
        found = substrings.substring_dedup(make(rows))
        assert collected(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows, 13)
