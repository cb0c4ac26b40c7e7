"""Compare every registered query with its DuckDB oracle at one scale factor.

usage: python scripts/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from tillroll.oracle.compare import compare, duck_connection  # noqa: E402
from tillroll.registry import oracle_sql, spark_queries  # noqa: E402
from tillroll.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    con = duck_connection(sf_dir)
    qs, sqls = spark_queries(), oracle_sql()
    bad = 0
    for key in sorted(qs):
        if only and key not in only:
            continue
        t0 = time.time()
        try:
            df = qs[key](spark, sf_dir)
            if key not in sqls:
                n = df.count()
                print(f"{key:40s} rows-only n={n}  {time.time() - t0:.1f}s")
                continue
            res = compare(df, sqls[key], con)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{key:40s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        status = "ok" if res["ok"] else "MISMATCH"
        if not res["ok"]:
            bad += 1
        extra = "" if res["ok"] else json.dumps({k: str(v)[:600] for k, v in res.items()})
        exact = "" if not res.get("ok") else ("exact" if res.get("exact") else "close")
        print(f"{key:40s} {status} {exact} rows={res['rows']} {time.time() - t0:.1f}s {extra}")
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
