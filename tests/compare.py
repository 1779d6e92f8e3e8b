"""Run registered queries and their SQL twins on the same tables and compare.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The small tables that the tests read.
TABLES = "/root/testdata/sf0.001"


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, float) else (True, "f", v) for v in row)


def _plain(v):
    if isinstance(v, float) and v == 0:
        return 0.0
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=_key)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL twin; empty when nothing does."""
    a_names, a = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    b_names, b = normal([d[0] for d in cur.description], cur.fetchall())
    if a_names != b_names:
        return [f"columns {a_names} / {b_names}"]
    if len(a) != len(b):
        return [f"rows {len(a)} / {len(b)}"]
    found = []
    for x, y in zip(a, b):
        for n, u, v in zip(a_names, x, y):
            if type(u) is not type(v):
                found.append(f"{n}: type {u!r} / {v!r}")
            elif u != v:
                near = isinstance(u, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9)
                found.append(f"{n}: {u!r} / {v!r}" + (" (near)" if near else ""))
    return found


def main() -> None:
    from riskloom.plans.catalog import QUERIES
    from riskloom.plans.oracle import ORACLE
    from riskloom.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if (names and name not in names) or (not names and name not in ORACLE):
            continue
        start = time.time()
        try:
            if name in ORACLE:
                found = differences(run(spark, folder), con, ORACLE[name])
            else:
                rows = run(spark, folder).collect()
                found = []
                print("   ", len(rows), rows[:12])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.2f}s", *found[:4], sep="\n      " if found else " ", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
