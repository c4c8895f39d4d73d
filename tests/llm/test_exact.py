import hashlib

from pyspark.sql import functions as F

from tablerich.llm import exact

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in SPACE), []).append((d, t or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(key.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=repr)


def result(df):
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


ROWS = [(1, "a b"), (2, "a  b"), (3, "ab"), (4, "a\x0bb\r"), (5, "a b"), (6, "A b"), (7, None), (8, ""), (9, " ")]


def test_against_brute_force(make, hard):
    for rows in (ROWS, hard, [(i % 50, "w" * (i % 7) + " " * (i % 3)) for i in range(400)]):
        assert result(exact.exact_dedup(make(rows))) == brute(rows)


def test_texts_under_one_digest_are_told_apart_by_their_bytes(make):
    rows = [r for r in ROWS if r[0]] + [(20, "a b")]
    found = exact.exact_dedup(make(rows), digest=lambda t: F.length(t).cast("string"))
    assert [r[:4] for r in result(found)] == [r[:4] for r in brute(rows)]
    # Rows without a doc_id too, as holders and as hits.
    for rows in ([(1, "aa"), (None, "bb"), (2, "cc")], [(None, "aa"), (None, "bb")], [(None, "bb "), (3, "aa"), (3, "bb"), (4, "aa")]):
        found = exact.exact_dedup(make(rows), digest=lambda t: F.lit("same"))
        assert [r[:4] for r in result(found)] == [r[:4] for r in brute(rows)]


def test_state_goes_on_between_calls(spark, make, tmp_path):
    log, out, state = (str(tmp_path / n) for n in ("log", "out", "state"))
    for part in ([(1, "x y"), (2, "z")], [(3, "x  y"), (4, "q")]):
        exact.keyed_log(make(part)).write.mode("append").parquet(log)
        exact.run_state(spark, log, "doc_id bigint, digest string, n_points int", state, out)
    rows = spark.read.parquet(f"{out}/*")
    last = rows.groupBy("digest").agg(F.max("holder.doc_id").alias("d"), F.max("seen").alias("n")).collect()
    assert sorted((r.d, r.n) for r in last) == [(2, 1), (3, 2), (4, 1)]


def test_kept_documents_keep_their_columns(make, hard):
    docs = make(hard)
    kept = exact.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        {(d is None, d or 0) for d, _, _, k, _ in brute(hard) if k}
    )


def test_empty_table(make):
    assert exact.exact_dedup(make([])).count() == 0
    assert exact.kept_documents(make([])).count() == 0
