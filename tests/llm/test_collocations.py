import collections
import random
import re

import numpy as np
import pytest

from tablerich.llm import collocations
from tablerich.session import cut_lineage


def plain_counts(rows):
    counts, words = collections.Counter(), collections.Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = re.findall("[^\x20\x09]+", piece)
            words[lang or "und"] += len(ws)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    counts[lang or "und", tuple(ws[i : i + k])] += 1
    return counts, words


def plain(rows, least, most=2000):
    f, n = plain_counts(rows)
    found = collections.defaultdict(list)
    candidates = {key for key, a in f.items() if len(key[1]) > 1 and a >= least}
    for lang, p in candidates:
        a = f[lang, p]
        if any(
            x == lang and len(q) > len(p) and 100 * f[x, q] >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            for x, q in candidates
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        s, k = min(cuts)
        found[lang].append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, rows in found.items():
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:most]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame([(i % 3 or None, t, x) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string")
    return df.selectExpr("*", "'x' AS gram", "1 AS k", "2 AS c", "3 AS n", "4 AS f").repartition(3)


def rows_of(seed, n=60):
    rng = random.Random(seed)
    words = ["The", "of", "é", "a\xa0b", "c", "d", "漢字", "x", "y1", "Ünd"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "; "]) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "de", None, "und"])))
    passage = "once upon a time there was a very long passage that all of them share without any pause in it"
    rows += [(f"{w} {passage}. {passage} {w}", "en") for w in words]
    rows += [(passage + " and goes on", "en")] * 3 + [(passage, "de")] * 4 + [("a a a a a a a a a a", "en")] * 3
    return rows + [(None, "en"), ("", None), (" \t\n.,", "en")]


def found(spark, rows, least, most=2000, buckets=1 << 16, **options):
    return sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least, most, buckets, **options).collect())


@pytest.mark.parametrize("least", [1, 2, 3, 8])
def test_against_brute_force(spark, least):
    rows = rows_of(least)
    assert found(spark, rows, least) == plain(rows, least)


def test_few_buckets_and_short_steps_change_nothing(spark):
    rows = rows_of(9, 20)
    for buckets, step in ((collocations.BLOCK, 1 << 10), (collocations.BLOCK * 2, 50)):
        assert found(spark, rows, 3, 7, buckets, step=step) == plain(rows, 3, 7)


def test_paths_are_compacted(spark):
    passage = [f"w{i}" for i in range(40)]
    rows = [(" ".join(passage), "en")] * 5 + [("z " + " ".join(passage[10:20]) + " z", "en")] * 4
    grams = cut_lineage(collocations.edges(frame(spark, rows), 2, 1 << 16), "grams")
    heavy = grams.filter("k = 5").select("lang", "gram", "c")
    ends = grams.filter("k = 4").select("lang", "gram", "c")
    paths = sorted((len(r.words), r.c) for r in collocations.compact(heavy, ends).collect())
    # The passage outside the shared part, both ways into it and out of it, and the part itself.
    assert sum(n - 4 for n, _ in paths) == heavy.count() and len(paths) == 5
    assert max(paths) == (24, 5) and (10, 9) in paths


def test_scores_beyond_64_bits(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(1, 10**12), rng.randrange(10**15, 10**16), rng.randrange(1, 10**13), rng.randrange(1, 10**13)) for _ in range(300)]
    rows.append((10**12, 10**16, 10**12, 10**13))
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select("a", "n", "l", "r", collocations.score("a", "n", "l", "r").alias("s")).collect()
    for a, n, left, right, s in got:
        if 1000 * a * n // (left * right) < 2**63:
            assert s == 1000 * a * n // (left * right)


def test_one_long_text_and_empty_table(spark):
    assert found(spark, [(None, None)], 2) == []
    assert collocations.collocations(frame(spark, [("a", "en")]).limit(0), 2, buckets=1 << 16).count() == 0
    text = "".join(f"w{i % 7} x{i % 11}" + (", " if i % 9 == 0 else " ") for i in range(60_000))
    assert found(spark, [(text, "en")], 100, step=1 << 14) == plain([(text, "en")], 100)


def test_hash_does_not_depend_on_the_place():
    a = collocations._Words(b"xx the cat. the cat\n", np.array([0]), ["en"], {})
    pair = a.buckets(np.zeros(1, np.uint64), collocations.BUCKETS)
    assert pair[1] == pair[3] != pair[0]
    assert a.joined.tolist() == [True, True, False, True, False]


def test_a_step_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    text = " ".join(f"w{i * i % 997} x{i}" for i in range(600_000)).replace("7 ", "7. ")
    batch = pa.RecordBatch.from_pydict({"text": [text], "lang": ["en"]})
    bits, names, words = np.full(collocations.BUCKETS // 8, 255, np.uint8), {}, 0
    tracemalloc.start()
    for data, begins, langs in collocations._steps([batch], collocations.STEP):
        step = collocations._Words(data, begins, langs, names)
        words += len(step.start)
        assert sum(int((k * c).sum()) for _, _, k, c in collocations._step_grams(step, bits, names, collocations.BUCKETS)) >= len(step.start)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == 1_200_000 and peak < 150 << 20
