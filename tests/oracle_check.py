"""Run registered queries against their SQL on the driver tables and compare whole results.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

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


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (0, "") if math.isnan(v) else (2, repr(v + 0.0))
    if isinstance(v, int):
        return (2, repr(float(v)))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cols = sorted(df.columns)
        return f"{len(bad)} rows differ, e.g. " + str([(c, x[1], y[1]) for c, x, y in zip(cols, g, w) if x != y][:4])
    return None


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    if os.environ.get("TUNE"):  # no broadcasts guessed from file sizes: the joins of a large run
        from tallyfield.session import tune

        tune(spark)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    con = connect(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = 0
    for name in argv[1:] or list(qs):
        t0 = time.time()
        try:
            diff = compare(spark, con, sf_dir, qs[name], sqls[name]) if name in sqls else "no SQL"
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:400]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'DIFF'} {name:28s} {time.time() - t0:6.2f}s {diff or ''}", flush=True)
    print(f"{failed} of {len(argv[1:] or qs)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
