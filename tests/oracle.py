"""Side-by-side run of the registered queries on Spark and DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) for v in row)


def normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str:
    """Empty if both agree, else what differs."""
    df = fn(spark, sf_dir)
    left = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    right = normal(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"\n   spark {a}\n   duck  {b}"
    return "" if left else "no rows"


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, fn, oracles[name])
            else:
                problem = "" if fn(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {'' if name in oracles else '(rows only) '}{problem}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    spark.stop()
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
