"""Compare queries with their SQL in DuckDB: ``python tests/oracle.py SF_DIR [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def type_problem(df, description):
    expected = {d[0]: str(d[1]) for d in description}
    got = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (t, expected[c]) for c, t in got.items() if expected.get(c) != t}
    return f"types {wrong}" if wrong else None


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, fn, sql):
    """A message about the first difference, or None; with the row count and seconds."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, len(got), seconds
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", len(got), seconds
    wrong = type_problem(df, cursor.description)
    if wrong:
        return wrong, len(got), seconds
    a, b = sorted_rows(df.columns, got), sorted_rows(columns, expected)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}: {sorted(set(map(repr, a)) ^ set(map(repr, b)))[:3]}", len(got), seconds
    for x, y in zip(a, b):
        if x != y or [type(i) for i in x] != [type(i) for i in y]:
            return f"spark {str(x)[:600]}\n   duckdb {str(y)[:600]}", len(got), seconds
    return None, len(got), seconds


def main():
    from __spark_entry__ import oracle_sql, queries
    from tablerich.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(**{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        try:
            problem, rows, seconds = compare(spark, con, sf_dir, fn, sql.get(name))
        except Exception as exc:
            problem, rows, seconds = f"{type(exc).__name__}: {str(exc)[:1500]}", -1, 0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {seconds:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
