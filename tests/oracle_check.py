"""Run every registered query against its DuckDB oracle, like the driver's gate.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, status, Spark rows, oracle rows.
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from reelmart.session import get_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if hasattr(v, "as_tuple"):  # Decimal
        return format(v.normalize(), "f") if v == v else None
    return repr(v) if not isinstance(v, str) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            df = fn(spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} SPARK-ERROR {type(exc).__name__}: {str(exc)[:300]}")
            bad += 1
            continue
        if name not in oracles:
            print(f"{name:34s} NO-ORACLE  spark={len(s_rows)}")
            continue
        try:
            res = con.execute(oracles[name])
            o_cols = [d[0] for d in res.description]
            o_rows = res.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:34s} ORACLE-ERROR {str(exc)[:300]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(o_cols):
            print(f"{name:34s} COLUMNS {sorted(set(s_cols) ^ set(o_cols))}")
            bad += 1
            continue
        a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
        if a == b:
            print(f"{name:34s} OK         rows={len(s_rows)}")
        else:
            bad += 1
            print(f"{name:34s} MISMATCH   spark={len(s_rows)} oracle={len(o_rows)}")
            only_s, only_o = list((a - b).elements())[:3], list((b - a).elements())[:3]
            cols = sorted(s_cols)
            print("   cols:", cols)
            for r in only_s:
                print("   spark :", r)
            for r in only_o:
                print("   oracle:", r)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
