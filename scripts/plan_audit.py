"""Scan the physical plan of every registered query for scale hazards.

usage: python scripts/plan_audit.py [sf_dir] > PLANS.md

Counts shuffles, broadcasts and sorts per key and flags:
  * CartesianProduct (a cross join that is not a one-row broadcast),
  * Python evaluation nodes (row or Arrow UDFs),
  * single-partition exchanges (every one is listed with its input so the
    bound can be checked against the comment at its source).
The plan is the pre-execution AQE plan (``explain`` of the final physical plan).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from tillroll.plans.warehouse import Warehouse  # noqa: E402
from tillroll.registry import output_edge, plan_functions  # noqa: E402
from tillroll.session import build_session  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    wh = Warehouse.for_source(spark, sf_dir)
    wh.build()
    rows, builds, flags = [], [], []

    def audited(key: str, txt: str) -> tuple:
        count = lambda pattern: len(re.findall(pattern, txt))
        cart, py = count("CartesianProduct"), count("BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow")
        sort_agg, expand = count("SortAggregate"), count(r"Expand \[")
        if cart or py:
            flags.append(f"- `{key}`: CartesianProduct={cart} Python={py}")
        if sort_agg or expand:
            flags.append(f"- `{key}`: SortAggregate={sort_agg} Expand={expand}")
        return (key, count("FileScan"), count("Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin"),
                count("Exchange SinglePartition"), count("BroadcastExchange"), count("SortMergeJoin"), sort_agg, expand, cart, py)

    for name in Warehouse.ORDER:
        builds.append(audited(f"build {name}", plan_text(wh._compute(name))))
    for key, fn in sorted(plan_functions().items()):
        rows.append(audited(key, plan_text(output_edge(fn(wh)))))
    print("# Physical plan audit\n")
    print(f"Tables: `{sf_dir}`. Columns: file scans, hash/range shuffles, single-partition exchanges, "
          "broadcasts, sort-merge joins, sort-based aggregations, expansions, Cartesian products, Python nodes (on Arrow batches).\n")
    print("| key | scans | shuffles | single-partition | broadcasts | SMJ | sort agg. | expand | cartesian | python |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for r in [*builds, *rows]:
        print("| " + " | ".join(str(x) for x in r) + " |")
    print("\n`build` rows: the layers' plans up to their write. The write of `fact_order_lines` adds one exchange by invoice (its buckets), "
          "that of `fact_orders` one by month.")
    print("\n## Flags\n")
    print("\n".join(flags) if flags else "none: no Cartesian product, Python node, sort-based aggregation or expansion in any plan.")
    spark.stop()


if __name__ == "__main__":
    main()
