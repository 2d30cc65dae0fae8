"""Command line: run the pipeline, show a view, or print the quality report.

    python -m claimlake run --raw claims.csv --format csv --out /data/lake [--profile lambda]
    python -m claimlake view --out /data/lake --name vw_financial_summary [--limit 50]
    python -m claimlake quality --out /data/lake
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="claimlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="raw -> Bronze -> Silver -> Gold")
    r.add_argument("--raw", required=True)
    r.add_argument("--format", default="csv", choices=["csv", "json", "parquet"])
    r.add_argument("--out", required=True)
    r.add_argument("--profile", default="lambda", choices=["lambda", "doc", "notebook"])
    r.add_argument("--batch-id")
    r.add_argument("--marts", action="store_true")
    v = sub.add_parser("view", help="show a reporting view over a written star")
    v.add_argument("--out", required=True)
    v.add_argument("--name", required=True)
    v.add_argument("--limit", type=int, default=50)
    q = sub.add_parser("quality", help="Silver quality report of a written lake")
    q.add_argument("--out", required=True)
    args = p.parse_args(argv)

    from claimlake.session import get_spark
    spark = get_spark()
    if args.cmd == "run":
        from claimlake.plans.pipeline import run
        from claimlake.sources.readers import ingest_raw
        raw = ingest_raw(spark, args.raw, fmt=args.format)
        status = run(spark, raw, args.out, profile=args.profile, batch_id=args.batch_id, marts=args.marts)
        status.show(truncate=False)
        return 0 if all(r.status == "SUCCESS" for r in status.collect()) else 1
    if args.cmd == "view":
        from claimlake.plans import views as V
        from claimlake.plans.pipeline import read_star
        star = read_star(spark, os.path.join(args.out, "gold"), os.path.join(args.out, "silver"))
        if args.name not in V.VIEWS:
            print(f"unknown view {args.name}; one of {sorted(V.VIEWS)}", file=sys.stderr)
            return 2
        V.VIEWS[args.name](star).show(args.limit, truncate=False)
        return 0
    from claimlake.operators.quality import quality_report
    quality_report(spark.read.parquet(os.path.join(args.out, "silver"))).show(vertical=True, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
