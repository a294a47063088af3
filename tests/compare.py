"""Run registered queries and their SQL side by side.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def engine(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return db


def differences(spark_df, db, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    names = sorted(spark_df.columns)
    got = Counter(tuple(r[n] for n in names) for r in spark_df.collect())
    result = db.execute(sql)
    order = [d[0] for d in result.description]
    if sorted(order) != names:
        return f"columns {names} / {sorted(order)}"
    at = [order.index(n) for n in names]
    want = Counter(tuple(r[i] for i in at) for r in result.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    show = lambda c: sorted(c.elements(), key=str)[:3]
    return (
        f"rows {sum(got.values())}/{sum(want.values())}, differ {sum(extra.values())}/{sum(missing.values())}\n"
        f"    columns  {names}\n    spark    {show(extra)}\n    expected {show(missing)}"
    )


def main() -> None:
    from support import session

    from __spark_entry__ import oracle_sql, queries

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, db = session(), engine(sf)
    registered, oracles = queries(), oracle_sql()
    bad = []
    for name in args or registered:
        began = time.time()
        try:
            found = differences(registered[name](spark, sf), db, oracles[name]) if name in oracles else (
                f"no SQL; {registered[name](spark, sf).count()} rows"
            )
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - began:.1f}s", flush=True)
        if found:
            bad.append(name)
            print("   ", found, flush=True)
    print(f"{len(args or registered)} queries, {len(bad)} differ: {bad}")


if __name__ == "__main__":
    main()
