"""Run every registered query against its oracle SQL and print a summary.

usage: python tests/run_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

from kinora.session import get_spark  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or sorted(E.queries())
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for k in keys:
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            if k not in sqls:
                n = df.count()
                print(f"{k:32s} rows={n} (no oracle) {time.time()-t:.1f}s", flush=True)
                continue
            r = compare(df, con, sqls[k])
        except Exception as exc:  # noqa: BLE001
            print(f"{k:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}", flush=True)
            bad.append(k)
            continue
        status = "OK " if r["ok"] else "BAD"
        print(f"{k:32s} {status} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"cols={r['cols_match']} diffs={r.get('value_diffs')} {time.time()-t:.1f}s", flush=True)
        if not r["ok"]:
            bad.append(k)
            print("   ", r.get("spark_cols"), r.get("oracle_cols"))
            for a, b in r.get("examples", []):
                print("    spark :", a)
                print("    oracle:", b)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
