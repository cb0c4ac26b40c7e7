"""The full build as one Spark application: layers in order, reconciliation
checks that stop the run when they fail, then the CSV extracts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillroll.plans import checks, customers
from tillroll.plans.exports import write_extracts
from tillroll.plans.warehouse import Warehouse


class CheckFailed(AssertionError):
    pass


# check key → the boolean columns that must be true, and the counts that must be 0
_RULES = {
    "check_bronze": (checks.check_bronze, ["bronze_is_valid"], []),
    "check_categories": (checks.check_categories, [], ["missing_categories"]),
    "check_orders": (checks.check_orders, ["grain_valid"], []),
    "check_customers": (checks.check_customers, ["grain_valid"], []),
    "check_products": (checks.check_products, ["grain_valid"], []),
    "check_rfm": (customers.check_rfm, ["grain_valid", "scores_valid"], ["recency_lt_0", "frequency_le_0"]),
}


def run_checks(wh: Warehouse) -> dict[str, dict]:
    """Evaluate K1–K11; raise ``CheckFailed`` listing every failed rule."""
    results, failed = {}, []
    for key, (fn, must_true, must_zero) in _RULES.items():
        row = fn(wh).collect()[0].asDict()   # each check is one small row
        results[key] = row
        failed += [f"{key}.{c}" for c in must_true if row[c] is not True]
        failed += [f"{key}.{c}={row[c]}" for c in must_zero if row[c] != 0]
    if failed:
        raise CheckFailed("reconciliation failed: " + ", ".join(failed))
    return results


def run_pipeline(spark: SparkSession, sf_dir: str, extracts_dir: str | None = None) -> dict:
    wh = Warehouse.for_source(spark, sf_dir)
    wh.build()
    out = {"warehouse": wh.root, "checks": run_checks(wh)}
    if extracts_dir:
        out["extracts"] = write_extracts(wh, extracts_dir)
    return out
