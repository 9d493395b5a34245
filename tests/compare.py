"""Run every registered query beside its SQL twin and report differences.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(v):
    """Values of both engines in one form."""
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if x is None else "", str(x)) for x in row)


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    con.close()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=key)


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, sorted((tuple(plain(x) for x in r) for r in rows), key=key)


def difference(a, b) -> str | None:
    """None when equal; integers and whole floats count as the same."""
    (na, ra), (nb, rb) = a, b
    if na != nb:
        return f"columns {na} != {nb}"
    if len(ra) != len(rb):
        return f"rows {len(ra)} != {len(rb)}"
    sa, sb = sorted(map(canon, ra)), sorted(map(canon, rb))
    bad = [(x, y) for x, y in zip(sa, sb) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def canon(row):
    return tuple(
        "" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool)
        else str(v)
        for v in row
    )


def main() -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as e
    from tests.conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session()
    queries, oracle = e.queries(), e.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if chosen and name not in chosen:
            continue
        t = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            took = time.time() - t
            if name in oracle:
                msg = difference(got, duck(sf_dir, oracle[name]))
                state = "ok" if msg is None else f"DIFF {msg}"
            else:
                state = "rows only"
            size = len(got[1])
        except Exception as x:  # noqa: BLE001
            state, size, took = f"ERROR {str(x)[:1500]}", -1, time.time() - t
        failed += not state.startswith(("ok", "rows"))
        print(f"{name:28s} {size:8d} {took:6.1f}s {state}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
