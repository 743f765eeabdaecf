"""Compare the Spark form of a query with its SQL twin in DuckDB.

``python -m tests.oracle [sf] [name …]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ROOT = os.environ.get("TESTDATA", "/root/testdata")


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(value(x) for x in v)
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def duck(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names, kinds = [d[0] for d in cur.description], [str(d[1]).lower() for d in cur.description]
    return names, kinds, cur.fetchall()


KINDS = {"bigint": "bigint", "integer": "int", "double": "double", "varchar": "string", "boolean": "boolean"}


def compare(spark, name, fn, sql, sf_dir):
    """Empty string when both agree, else what differs."""
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if rows else "no rows"
    names, kinds, expected = duck(sql, sf_dir)
    got_names, got = normal(df.columns, rows)
    want_names, want = normal(names, expected)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    spark_kinds = dict(df.dtypes)
    odd = [
        (n, k, spark_kinds[n]) for n, k in zip(names, kinds) if KINDS.get(k, k) != spark_kinds[n]
    ]
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    if diff:
        return f"{len(diff)} of {len(want)} rows differ, first {diff[:2]}"
    return "" if want else "empty on both sides"


def main():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from arealis.session import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    sqls = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            result = compare(spark, name, fn, sqls.get(name), f"{ROOT}/sf{sf}")
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(result)
        mark = "ok " if not result else "BAD"
        print(f"{mark} {name:40s} {time.time() - start:6.2f}s {'' if name in sqls else '(rows only)'} {result}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
