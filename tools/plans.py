"""Print the physical plan tree of selected views/operators over a written star.

Usage: python tools/plans.py [sf_dir] > PLANS.md
Builds the layers once (pipeline.run, bucketed claim facts too), then prints the
operator tree of `explain("formatted")` plus the scan lines (pushed filters,
read schema) for each plan.
"""

from __future__ import annotations

import io
import os
import sys
import uuid
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _tree(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head, _, rest = text.partition("\n\n")
    scans = [line for line in rest.splitlines() if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return head.strip() + "\n\n" + "\n".join(scans)


def main() -> None:
    from pyspark.sql import functions as F
    from claimlake.operators.dedup import keep_first, quarantine
    from claimlake.plans import analysis as A, views as V
    from claimlake.plans.pipeline import read_star, run
    from claimlake.session import checkpoint_dir, get_spark
    from claimlake.sources.fixture import raw_claims

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16)
    out = os.path.join(checkpoint_dir(spark), f"plans-{uuid.uuid4().hex}")
    prefix = f"p{uuid.uuid4().hex[:6]}_"
    run(spark, raw_claims(spark, sf_dir), out, batch_id="20240101_000000", bucket_claims=16,
        table_prefix=prefix).collect()
    star = read_star(spark, os.path.join(out, "gold"), os.path.join(out, "silver"))
    bucketed = read_star(spark, os.path.join(out, "gold"), os.path.join(out, "silver"), table_prefix=prefix)
    items = {
        "V1 vw_monthly_costs (pre-aggregate by NPI, then join the provider dimension)": V.monthly_costs(star),
        "V3 vw_covid19_tests (code list pushed to the scan)": V.covid19_tests(star),
        "V7 vw_financial_summary, month filter (partition pruning)":
            V.financial_summary(star.__class__(**{**star.__dict__, "fact_claims":
                star.fact_claims.where(F.col("service_month") >= "2022-01")})),
        "V17b vw_revenue_cycle_kpi_wide, Parquet layout": V.revenue_cycle_kpi_wide(star),
        "V17b vw_revenue_cycle_kpi_wide, bucketed claim facts": V.revenue_cycle_kpi_wide(bucketed),
        "Q5 lab market share (scalar subquery for the total, top-k)": A.lab_market_share(star),
        "W1 keep_first dedup (partial WindowGroupLimit before the shuffle)": keep_first(star.silver),
        "W2 quarantine (grouped count + null-safe semi join)": quarantine(star.silver),
    }
    print("# Physical plans\n")
    print(f"Generated by `python tools/plans.py {sf_dir}` (local[8], AQE on; the initial plan "
          "is shown: AQE may still switch a join to broadcast at runtime from measured sizes).\n")
    for title, df in items.items():
        print(f"## {title}\n\n```\n{_tree(df)}\n```\n")


if __name__ == "__main__":
    main()
