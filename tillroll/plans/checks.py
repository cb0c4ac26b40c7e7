"""Reconciliation checks K1–K8: each is one small DataFrame of named values
(the booleans are what a test asserts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.numeric import count_when, rounded_money
from tillroll.plans import metrics
from tillroll.plans.parts import by_invoice


def check_bronze(wh) -> DataFrame:
    """K1: the lines that passed when the raw period files were consolidated and written
    (observed then) vs a scan of the stored bronze table."""
    sides = [df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
             for p, df in (("source", metrics.stored(wh, "bronze")), ("bronze", metrics.measured("bronze", wh.table("bronze"))))]
    # two one-row tables: a bounded cross join.
    j = sides[0].crossJoin(F.broadcast(sides[1]))
    valid = ((F.col("source_rows") == F.col("bronze_rows"))
             & (F.col("source_total_quantity") == F.col("bronze_total_quantity"))
             & (F.abs(F.col("source_total_price") - F.col("bronze_total_price")) < F.lit(0.01))
             & (F.col("source_missing_customer") == F.col("bronze_missing_customer"))
             & (F.col("source_min_date") == F.col("bronze_min_date"))
             & (F.col("source_max_date") == F.col("bronze_max_date")))
    cols = [c for c in j.columns if not c.endswith("_total_price")]
    return j.select(*cols, F.col("source_total_price").cast("double").alias("source_total_price"),
                    F.col("bronze_total_price").cast("double").alias("bronze_total_price"),
                    valid.alias("bronze_is_valid"))


def check_stored_metrics(wh) -> DataFrame:
    """Per table, whether the metrics observed when it was written are those of
    one scan of the stored table."""
    parts = []
    for name in metrics.OBSERVED:
        now, then = metrics.measured(name, wh.table(name)), metrics.stored(wh, name)
        first = now.columns[0]  # the rows
        same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in now.columns])
        # two one-row tables
        parts.append(now.alias("a").crossJoin(F.broadcast(then.alias("b"))).select(
            F.lit(name).alias("table"), F.col(f"a.{first}").alias("rows"), same.alias("metrics_match")))
    return reduce(DataFrame.unionByName, parts).orderBy("table")


def check_silver_flags(wh) -> DataFrame:
    """K2 + S11: flag totals, row and column counts of the silver table, as observed when it
    was written."""
    columns = F.lit(len(wh.table("silver_transactions").columns)).cast("bigint").alias("columns")
    return metrics.stored(wh, "silver_transactions").select("rows", columns, *S.QUALITY_FLAGS)


def check_categories(wh) -> DataFrame:
    """K3 + J2: special rows / codes re-joined to the reference, missing categories."""
    s = wh.table("silver_transactions")
    ref = F.broadcast(wh.categories().select(F.col("stock_code").alias("_ref_code")))  # 62 rows
    j = s.join(ref, s[S.STOCK_CODE] == ref["_ref_code"], "left")
    return j.agg(
        F.count(F.col("_ref_code")).alias("special_rows"),
        F.countDistinct(F.when(F.col("_ref_code").isNotNull(), F.col(S.STOCK_CODE))).alias("special_codes"),
        count_when(F.col("line_category").isNull()).alias("missing_categories"),
    )


def category_counts(wh) -> DataFrame:
    """K4: rows per line category."""
    s = wh.table("silver_transactions")
    return s.groupBy("line_category").agg(F.count(F.lit(1)).alias("rows")) \
            .orderBy(F.col("rows").desc(), "line_category")


def _sales(df: DataFrame, *others) -> DataFrame:
    named = zip(metrics.SALES, ("gross_product_sales", "product_cancellations", "net_product_sales"))
    return df.select(*others, *[rounded_money(c).alias(name) for c, name in named])


def check_order_lines(wh) -> DataFrame:
    """K5, as observed when the table was written."""
    return _sales(metrics.stored(wh, "fact_order_lines"), "rows", "product_sale_rows", "product_cancellation_rows")


def check_orders(wh) -> DataFrame:
    """K6: order grain = distinct invoices of the lines, same totals; totals as observed when
    the table was written, invoices counted on the stored lines."""
    lines = by_invoice(wh, lambda d: d.groupBy(S.INVOICE).agg(F.count(F.lit(1)).alias("n"))).agg(
        F.count(S.INVOICE).alias("expected_orders"))
    # count(column) ignores a null invoice; the orders table keeps it as a group.
    return _sales(metrics.stored(wh, "fact_orders"), "orders").crossJoin(F.broadcast(lines)).withColumn(
        "grain_valid", F.col("orders") == F.col("expected_orders"))


def check_customers(wh) -> DataFrame:
    """K7: one scan of the stored dimension counts its distinct ids."""
    distinct = wh.table("dim_customers").agg(F.countDistinct("customer_id").alias("distinct_customers"))
    return metrics.stored(wh, "dim_customers").crossJoin(F.broadcast(distinct)).select(
        "customers", "distinct_customers", "multi_country_customers", "first_activity", "last_activity",
        (F.col("customers") == F.col("distinct_customers")).alias("grain_valid"))


def check_products(wh) -> DataFrame:
    """K8: one scan of the stored dimension counts its distinct codes."""
    distinct = wh.table("dim_products").agg(F.countDistinct("stock_code").alias("distinct_stock_codes"))
    return metrics.stored(wh, "dim_products").crossJoin(F.broadcast(distinct)).select(
        "products", "distinct_stock_codes", "missing_descriptions", "multiple_description_codes",
        (F.col("products") == F.col("distinct_stock_codes")).alias("grain_valid"))
