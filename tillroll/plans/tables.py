"""Warehouse tables as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.sources.periods import bronze_summary as _bronze_summary


def ingest_consolidated(wh) -> DataFrame:
    return wh.table("bronze")


def bronze_summary(wh) -> DataFrame:
    return _bronze_summary(wh.table("bronze"))


def silver_lines(wh) -> DataFrame:
    return wh.table("silver_transactions")


def fact_order_lines(wh) -> DataFrame:
    return wh.table("fact_order_lines")


def fact_orders(wh) -> DataFrame:
    return wh.table("fact_orders")


def dim_customers(wh) -> DataFrame:
    return wh.table("dim_customers")


def dim_products(wh) -> DataFrame:
    return wh.table("dim_products")


def customer_rfm(wh) -> DataFrame:
    return wh.table("customer_rfm")


def table_columns(wh, table: str = "fact_order_lines") -> DataFrame:
    """Column names and types of a warehouse table (``DESCRIBE`` on its view)."""
    view = f"tillroll_{table}"
    wh.table(table).createOrReplaceTempView(view)
    return wh.spark.sql(f"DESCRIBE TABLE {view}").selectExpr(
        "col_name AS column_name", "data_type AS column_type")
