"""BI extracts (S7–S10) and their CSV sink.

Each extract is a DataFrame with a total order; ``write_extracts`` writes
them as CSV with a header.  The sort is a distributed range sort
(part files are ordered by name), not a single-task sort.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import calendar as CAL
from tillroll.plans.audit import audit_classification
from tillroll.plans.customers import export_rfm


def export_orders(wh) -> DataFrame:
    """One row per invoice, ordered by time."""
    fo = wh.table("fact_orders")
    return (fo.select(F.col(S.INVOICE).alias("invoice"), "order_datetime", "customer_id", "country",
                      "line_count", "distinct_stockcodes", "product_sale_quantity",
                      "product_cancellation_quantity",
                      F.col("gross_product_sales_value").cast("double").alias("gross_product_sales_value"),
                      F.col("product_cancellation_value").cast("double").alias("product_cancellation_value"),
                      F.col("net_product_sales_value").cast("double").alias("net_product_sales_value"),
                      "is_cancellation", "has_product_sale", "has_product_cancellation")
              .orderBy("order_datetime", "invoice"))


def export_products_monthly(wh) -> DataFrame:
    """S9 + A17: month × country × product, product lines only.

    The two ``COUNT(DISTINCT CASE …)`` become a two-level aggregation: first
    per (month, country, code, invoice) — partial, map-side — then per
    (month, country, code), counting invoices that had a sale / cancellation.
    This shuffles the lines twice instead of expanding them three-fold.
    The product dimension (unique per code) is attached after aggregating."""
    fol = wh.table("fact_order_lines").filter(F.col("line_category") == "product")
    sale, cancel = F.col("is_product_sale"), F.col("is_product_cancellation")
    keys = [CAL.month_start(S.INVOICE_DATE).alias("month"), F.col(S.COUNTRY).alias("country"),
            F.col(S.STOCK_CODE).alias("stock_code")]
    per_invoice = fol.groupBy(*keys, S.INVOICE).agg(
        F.sum("gross_product_sales_value").alias("_g"),
        F.sum("product_cancellation_value").alias("_c"),
        F.sum("net_product_sales_value").alias("_n"),
        F.sum(F.when(sale, F.col(S.QUANTITY)).otherwise(0)).alias("_sq"),
        F.sum(F.when(cancel, F.col(S.QUANTITY)).otherwise(0)).alias("_cq"),
        F.bool_or(sale).alias("_has_sale"),
        F.bool_or(cancel).alias("_has_cancel"))
    agg = per_invoice.groupBy("month", "country", "stock_code").agg(
        F.sum("_g").cast("double").alias("gross_product_sales_value"),
        F.sum("_c").cast("double").alias("product_cancellation_value"),
        F.sum("_n").cast("double").alias("net_product_sales_value"),
        F.sum("_sq").cast("bigint").alias("product_sale_quantity"),
        F.sum("_cq").cast("bigint").alias("product_cancellation_quantity"),
        F.count_if(F.col("_has_sale") & F.col(S.INVOICE).isNotNull()).alias("purchase_invoices"),
        F.count_if(F.col("_has_cancel") & F.col(S.INVOICE).isNotNull()).alias("cancellation_invoices"),
    )
    dp = wh.table("dim_products").select("stock_code", "product_description")
    return (agg.join(dp, "stock_code", "left")
               .select("month", "country", "stock_code", "product_description",
                       "gross_product_sales_value", "product_cancellation_value", "net_product_sales_value",
                       "product_sale_quantity", "product_cancellation_quantity",
                       "purchase_invoices", "cancellation_invoices")
               .orderBy("month", "country", "stock_code"))


EXTRACTS = {
    "tableau_orders": export_orders,
    "tableau_rfm": export_rfm,
    "tableau_products_monthly": export_products_monthly,
    "stockcode_categories": audit_classification,  # S10
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; an ordered DataFrame keeps its order across part files."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_extracts(wh, out_dir: str) -> dict[str, str]:
    paths = {}
    for name, fn in EXTRACTS.items():
        path = os.path.join(out_dir, name)
        write_csv(fn(wh), path)
        paths[name] = path
    return paths
