"""Runs a query and its SQL twin side by side and compares them as multisets."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (2, "nan") if math.isnan(f) else (2, float(f"{f:.12g}"))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return (3, v.isoformat())
    return (4, str(v))


def compare(spark, con, query, sql, sf) -> tuple[str, float]:
    begun = time.monotonic()
    df = query(spark, sf)
    names = df.columns
    rows = [tuple(r) for r in df.collect()]
    took = time.monotonic() - begun
    if sql is None:
        return (f"rows-only {len(rows)}" if rows else "EMPTY"), took
    found = con.execute(sql)
    theirs = [d[0] for d in found.description]
    if sorted(theirs) != sorted(names):
        return f"COLUMNS {sorted(names)} != {sorted(theirs)}", took
    order = [theirs.index(c) for c in sorted(names)]
    mine_at = [names.index(c) for c in sorted(names)]
    want = sorted(tuple(_plain(r[i]) for i in order) for r in found.fetchall())
    have = sorted(tuple(_plain(r[i]) for i in mine_at) for r in rows)
    if len(want) != len(have):
        return f"ROWS {len(have)} != {len(want)}", took
    differ = [(h, w) for h, w in zip(have, want) if h != w]
    if differ:
        return f"VALUES {len(differ)} of {len(have)}: {sorted(names)} have {[x[1] for x in differ[0][0]]} want {[x[1] for x in differ[0][1]]}", took
    return f"ok {len(have)}" if have else "EMPTY", took


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from arealis.session import get_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(sf), oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            result, took = compare(spark, con, query, twins.get(name), sf)
        except Exception as e:  # noqa: BLE001
            result, took = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0.0
        good = result.startswith(("ok", "rows-only"))
        bad += not good
        print(f"{'    ' if good else '!!! '}{name:28s} {took:6.2f}s {result}", flush=True)
    print(f"{bad} bad")
