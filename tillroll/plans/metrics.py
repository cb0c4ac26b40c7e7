"""What the checks need of a table, observed in the pass that writes it.

Each metric is an aggregate that partial results can be merged with.  ``Warehouse``
observes them on the last step before the files, whose tasks count once each, and stores
them beside the table; a table written in two parts has a row for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.numeric import count_when

Metric = tuple[Column, Callable]


def _rows() -> Metric:
    return F.count(F.lit(1)), F.sum


def _sum(c: str) -> Metric:
    return F.sum(c), F.sum


def _count(c: str) -> Metric:
    return count_when(F.col(c)), F.sum


def _money(*cols: str) -> dict[str, Metric]:
    return {c: _sum(c) for c in cols}


SALES = ("gross_product_sales_value", "product_cancellation_value", "net_product_sales_value")

#: Table → name → (aggregate, how parts are merged).
OBSERVED: dict[str, Callable[[], dict[str, Metric]]] = {
    "bronze": lambda: {
        "rows": _rows(), "total_quantity": (F.sum(S.QUANTITY).cast("bigint"), F.sum), "total_price": _sum(S.PRICE),
        "missing_customer": (count_when(F.col(S.CUSTOMER).isNull()), F.sum),
        "min_date": (F.min(S.INVOICE_DATE), F.min), "max_date": (F.max(S.INVOICE_DATE), F.max)},
    "silver_transactions": lambda: {"rows": _rows(), **{f: _count(f) for f in S.QUALITY_FLAGS}},
    "fact_order_lines": lambda: {
        "rows": _rows(), "product_sale_rows": _count("is_product_sale"),
        "product_cancellation_rows": _count("is_product_cancellation"), **_money(*SALES)},
    "fact_orders": lambda: {"orders": _rows(), **_money(*SALES)},
    "dim_customers": lambda: {
        "customers": _rows(), "multi_country_customers": _count("is_multi_country"),
        "first_activity": (F.min("first_activity_datetime"), F.min), "last_activity": (F.max("last_activity_datetime"), F.max)},
    "dim_products": lambda: {
        "products": _rows(), "missing_descriptions": (count_when(F.col("product_description").isNull()), F.sum),
        "multiple_description_codes": (count_when(F.col("distinct_descriptions") > 1), F.sum)},
}


def aggregates(name: str) -> list[Column]:
    return [column.alias(alias) for alias, (column, _) in OBSERVED[name]().items()]


def measured(name: str, df: DataFrame) -> DataFrame:
    """One row: the table's metrics, from a scan of ``df``."""
    return df.agg(*aggregates(name))


def merged(name: str, parts: DataFrame) -> DataFrame:
    """One row from the rows that were observed with a table's parts."""
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    return parts.agg(*[merge(alias).cast(kinds[alias]).alias(alias) for alias, (_, merge) in OBSERVED[name]().items()])


def stored(wh, name: str) -> DataFrame:
    """The metrics stored with a table; scanned where a warehouse keeps none."""
    kept = getattr(wh, "metrics", None)
    return (kept(name) if kept else None) or measured(name, wh.table(name))
