"""Benchmark: build the warehouse and run every registered query.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_SHUFFLE_PARTITIONS (default = cpus; AQE coalesces further), BENCH_QUERIES
(comma list to run a subset), BENCH_EVENT_LOG=1 (write Spark's event log to the
scratch folder; summarize with scripts/stage_times.py).
Prints ONE JSON line:
  {"metric": "total_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed completely with the ``noop`` sink (no driver
collection); warehouse layers and shared report tables are timed as ``build_*`` when
first built (write + read back).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from tillroll.plans.warehouse import Warehouse
    from tillroll.registry import derived_tables, plan_functions
    from tillroll.session import build_session, checkpoint_dir

    scratch = tempfile.mkdtemp(prefix="tillroll-bench-")
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    extra = {"spark.driver.memory": "16g", "spark.local.dir": os.path.join(scratch, "local")}
    if os.environ.get("BENCH_EVENT_LOG") == "1":
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.path.join(scratch, "events")})
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=partitions, extra=extra)
    # the shared folder the cluster names (set only if unset); a fresh warehouse
    # folder inside it, so every bench run measures a full build
    base = checkpoint_dir(spark)

    timings: dict[str, float] = {}
    t_all = time.time()
    wh = Warehouse(spark, sf_dir, root=os.path.join(base, "tillroll-bench", os.path.basename(scratch)))
    for name in Warehouse.ORDER:
        t0 = time.time()
        spark.sparkContext.setJobDescription(f"build_{name}")
        wh.table(name)
        timings[f"build_{name}"] = round(time.time() - t0, 3)

    # tables that several reports share are built before the reports are timed
    for name, build in sorted(derived_tables().items()):
        t0 = time.time()
        spark.sparkContext.setJobDescription(f"build_{name}")
        wh.derived(name, build)
        timings[f"build_{name}"] = round(time.time() - t0, 3)

    for key, fn in sorted(plan_functions().items()):
        if only and key not in only:
            continue
        t0 = time.time()
        spark.sparkContext.setJobDescription(key)
        fn(wh).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "scratch": scratch}))
    spark.stop()


if __name__ == "__main__":
    main()
