import collections
import re

import pytest

from tablerich.llm import host_rules


def plain_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = collections.defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "a b c a b c a b c", "a a a a", "a a a", "a b a b a", "x\ny\nx\n \n\t\n y", "# * $ % & | < > ## [^] \\", "a b c   d",
    "a b c d a b c e a b", " ".join(f"w{i % 97}" for i in range(5000)), "\n".join(["same line"] * 200),
]


def test_figures_against_plain_python(make, hard):
    rows = [*hard, *[(100 + i, t) for i, t in enumerate(TEXTS)]]
    got = host_rules.document_figures(make(rows)).collect()
    expected = sorted(((d, *plain_figures(t)) for d, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, *[r[c] for c in host_rules.FIGURES]) for r in got), key=repr) == expected


GOOD = " ".join(f"word{i}" for i in range(60))


def test_bad_hosts_lose_all_documents_small_ones_are_shrunk(make):
    rows = [(i, GOOD, f"good{i % 20}") for i in range(2000)]
    # Nine of ten fail, on many documents.
    rows += [(5000 + i, "too short" if i % 10 else GOOD, "bad") for i in range(300)]
    # One document, which fails: its host's rate stays below the limit.
    rows += [(6000, "short", "new"), (6001, GOOD, None), (6002, None, None)]
    docs = make(rows)
    got = {r.doc_id: r for r in host_rules.judged(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(2000)) and got[6001].kept
    assert not any(got[5000 + i].kept for i in range(300)) and not got[5010].base_failed
    assert got[6000].base_failed and not got[6000].host_rejected
    assert got[6002].base_failed and got[6002].n_words == 0
    rates = {r.source: r for r in host_rules.host_verdicts(host_rules.document_figures(docs)).collect()}
    assert rates["bad"].rejected and 0.85 < rates["bad"].rate_short < 0.9
    assert 0 < rates["new"].rate_short < 0.5 and rates["good1"].rate_short < 0.05


def test_prior_recovers_a_beta():
    import numpy as np

    rng = np.random.default_rng(3)
    n = rng.integers(20, 400, 3000)
    k = rng.binomial(n, rng.beta(2, 6, 3000))
    mean, strength = host_rules.prior(len(n), float(n.sum()), float((n * n).sum()), float(k.sum()), float((k * k / n).sum()))
    assert abs(mean - 0.25) < 0.01 and abs(strength - 8) < 1
    alike = rng.binomial(n, 0.25)
    sums = (len(n), float(n.sum()), float((n * n).sum()), float(alike.sum()), float((alike * alike / n).sum()))
    assert host_rules.prior(*sums)[1] > 300
    assert host_rules.prior(0, 0.0, 0.0, 0.0, 0.0) == (0.0, 2.0)
    assert host_rules.prior(1, 10.0, 100.0, 5.0, 2.5) == (0.5, 2.0)
    assert host_rules.prior(2, 10.0, 52.0, 0.0, 0.0) == (0.0, 2.0)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, GOOD), (None, GOOD)]])
def test_small_tables(make, rows):
    got = host_rules.judged(make(rows)).collect()
    assert [r.kept for r in got] == [t is not None for _, t in rows]


def test_no_python_in_the_plan(spark, sf):
    plan = host_rules.op11_host_quality_rules(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
