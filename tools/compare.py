"""Run registered queries against their SQL twins: ``python tools/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import threading
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, run, sql, sf_dir) -> tuple[bool, str]:
    t0 = time.time()
    limit = float(os.environ.get("QUERY_SECONDS", "60"))
    stop = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    stop.start()
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    stop.cancel()
    took = time.time() - t0
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {took:.2f}s"
    stop = threading.Timer(limit, con.interrupt)
    stop.start()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    stop.cancel()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        miss = [x for x in a if x not in set(b)][:3]
        extra = [x for x in b if x not in set(a)][:3]
        return False, f"rows {len(a)} vs {len(b)}; {sorted(names)}\n   spark only {miss}\n   sql only {extra}"
    return True, f"{len(got)} rows, {took:.2f}s"


def main(argv: list[str]) -> int:
    from ticketlake.queries import REGISTRY
    from ticketlake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(REGISTRY)
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in wanted:
        query = REGISTRY[name]
        try:
            ok, note = compare(spark, con, name, query.run, query.sql, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(wanted) - len(bad)} of {len(wanted)} match", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
