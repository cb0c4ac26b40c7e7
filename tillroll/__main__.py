"""Command line: build the warehouse, run the checks, write the extracts.

    python -m tillroll build  SF_DIR [--extracts OUT_DIR]
    python -m tillroll query  SF_DIR KEY [--rows N]

On a cluster the session comes from spark-submit; locally a local session is
created.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from tillroll.session import build_session
    return build_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build all layers, run the checks, optionally write extracts")
    b.add_argument("sf_dir")
    b.add_argument("--extracts")
    q = sub.add_parser("query", help="show one registered query")
    q.add_argument("sf_dir")
    q.add_argument("key")
    q.add_argument("--rows", type=int, default=20)
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "build":
        from tillroll.plans.pipeline import CheckFailed, run_pipeline
        try:
            out = run_pipeline(spark, args.sf_dir, args.extracts)
        except CheckFailed as e:
            print(str(e), file=sys.stderr)
            return 1
        print(json.dumps(out, default=str, indent=1))
        return 0
    from tillroll.registry import spark_queries
    qs = spark_queries()
    if args.key not in qs:
        print(f"unknown key {args.key}; known: {', '.join(sorted(qs))}", file=sys.stderr)
        return 2
    qs[args.key](spark, args.sf_dir).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
