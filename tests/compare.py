"""Runs the registered queries against their SQL twins and reports differences.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    return names, sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def duck_rows(con, text: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(text)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(r[i] for i in order) for r in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(spark, con, sf_dir: str, query, text: str) -> str | None:
    got_names, got = rows_of(query(spark, sf_dir))
    want_names, want = duck_rows(con, text)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"row {a} != {b}"
        kinds = [(type(x), type(y)) for x, y in zip(a, b) if x is not None and type(x) is not type(y)]
        if kinds:
            return f"types {kinds}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    queries, oracles = e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        if name not in oracles:
            print(f"{name}: {queries[name](spark, sf_dir).count()} rows, no twin", flush=True)
            continue
        try:
            problem = difference(spark, con, sf_dir, queries[name], oracles[name])
        except Exception as failure:  # report and go on with the next query
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.2f}s)", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
