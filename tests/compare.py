"""Runs registered queries beside their SQL in DuckDB and compares rows.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
ROOT = "/root/testdata"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def text(v: object) -> str:
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def difference(columns: list[str], rows: list, sql_columns: list[str], sql_rows: list) -> str | None:
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} / {sorted(sql_columns)}"
    a, b = normal(columns, rows), normal(sql_columns, sql_rows)
    if a == b:
        return None
    only_a, only_b = Counter(a) - Counter(b), Counter(b) - Counter(a)
    return (
        f"rows {len(a)} / {len(b)}; {sum(only_a.values())} only in Spark {list(only_a)[:3]}, "
        f"{sum(only_b.values())} only in SQL {list(only_b)[:3]}"
    )


def types(spark_df, rel) -> str | None:
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    off = [
        f"{n}: {t}/{duck_types.get(n)}"
        for n, t in spark_df.dtypes
        if same.get(t, t) != duck_types.get(n)
    ]
    return ", ".join(off) or None


def main(argv: list[str]) -> int:
    from glebe.session import local_session

    import __spark_entry__ as entry

    sf = argv[0] if argv else "sf0.001"
    sf_dir = f"{ROOT}/{sf}"
    spark = local_session()
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    failed = 0
    for n in names:
        t = time.time()
        try:
            df = queries[n](spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if n not in oracles:
                print(f"rows {n}: {len(got)} ({t1 - t:.1f}s)", flush=True)
                continue
            rel = con.sql(oracles[n])
            problem = difference(df.columns, got, rel.columns, rel.fetchall())
            note = types(df, rel)
            failed += problem is not None
            print(
                f"{'FAIL' if problem else 'ok  '} {n}: {len(got)} rows, spark {t1 - t:.1f}s duckdb {time.time() - t1:.1f}s"
                + (f" TYPES {note}" if note else "") + (f"\n{problem}" if problem else ""),
                flush=True,
            )
        except Exception as e:  # a broken query must not hide the others
            failed += 1
            print(f"FAIL {n}: {type(e).__name__} {str(e)[:1500]}", flush=True)
    print(f"{len(names)} checked, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
