import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, with columns that clash with inner names."""

    def docs(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC).repartition(3)
        if clash:
            for name in ("id", "digest", "row", "n", "part", "block", "fp", "size", "start", "shard", "score", "kept", "doc", "key", "c0"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return docs


HARD = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark woods again and again"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark woods again and again"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "word"),
    (None, "no name but a text of some length that is long enough to hold a window of fifty bytes or thirteen words"),
    (7, "no name but a text of some length that is long enough to hold a window of fifty bytes or thirteen words"),
    (8, "Ünïcode ẞ 漢字 \U0001f600 \x01 " * 40),
    (9, "x" * 300_000),
    (10, ("long " * 30_000) + "end"),
    (2, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark woods again and again"),
    (11, "a b  c\r\nd\x0be\x0cf"),
]


@pytest.fixture(scope="session")
def hard():
    return HARD
