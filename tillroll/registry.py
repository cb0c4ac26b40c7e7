"""Every query key → its Spark plan and its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.oracle.base import with_ctes
from tillroll.plans import audit, checks, customers, exports, incremental, sales, scope, tables
from tillroll.plans.warehouse import Warehouse

PLAN_MODULES = [tables, sales, customers, scope, checks, exports, audit, incremental]


def _oracle_modules():
    from tillroll.oracle import audit as o_audit, checks as o_checks, customers as o_customers
    from tillroll.oracle import exports as o_exports, sales as o_sales, scope as o_scope, tables as o_tables
    return [o_tables, o_sales, o_customers, o_scope, o_checks, o_exports, o_audit]


def plan_functions() -> dict[str, Callable]:
    out: dict[str, Callable] = {}
    for mod in PLAN_MODULES:
        for key in getattr(mod, "__all_queries__", None) or _public_queries(mod):
            out[key] = getattr(mod, key)
    return out


def derived_tables() -> dict[str, Callable]:
    """Tables that several reports share, by the name they are stored under."""
    return {"customer_purchase_counts": customers._compute_purchase_counts, "customer_value_curve": customers._pareto,
            "monthly_orders": sales._compute_monthly_orders, "product_totals": sales._compute_product_totals,
            "price_sketch": audit._compute_price_sketch, "order_lists": scope._compute_order_lists}


def _public_queries(mod) -> list[str]:
    oracle = oracle_bodies()
    names = []
    for name in dir(mod):
        if name.startswith("_"):
            continue
        obj = getattr(mod, name)
        if callable(obj) and getattr(obj, "__module__", None) == mod.__name__ and (
                name in oracle or name in NO_ORACLE):
            names.append(name)
    return names


# Keys whose result has no SQL statement (rows-only check).
NO_ORACLE: set[str] = set()


def oracle_bodies() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in _oracle_modules():
        out.update(mod.SQL)
    return out


def output_edge(df: DataFrame) -> DataFrame:
    """Money is exact DECIMAL inside every plan and DOUBLE in every result."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return output_edge(fn(Warehouse.for_source(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: bind(fn) for k, fn in sorted(plan_functions().items())}


def oracle_sql() -> dict[str, str]:
    keys = plan_functions()
    return {k: with_ctes(sql) for k, sql in sorted(oracle_bodies().items()) if k in keys}
