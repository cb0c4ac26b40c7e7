"""Metric-scope validation: categories, sign matrix, product scope, examples,
largest orders, dimension samples (A32–A36 partly, F9, F10, R1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.numeric import count_when, money, rounded_money
from tillroll.operators.top_lists import TopList, top_lists

SAMPLE_ROWS = 20


def category_summary(wh) -> DataFrame:
    """Per line category, sign counts and raw value."""
    s = wh.table("silver_transactions")
    return (s.groupBy("line_category").agg(
        F.count(F.lit(1)).alias("rows"),
        count_when(F.col("is_cancellation")).alias("cancellation_rows"),
        count_when(F.col(S.QUANTITY) > 0).alias("positive_quantity_rows"),
        count_when(F.col(S.QUANTITY) < 0).alias("negative_quantity_rows"),
        count_when(F.col(S.PRICE) > 0).alias("positive_price_rows"),
        rounded_money(F.sum("raw_line_value")).alias("raw_value"))
        .orderBy(F.col("rows").desc(), "line_category"))


def _sign(c: str):
    return (F.when(F.col(c) > 0, "positive").when(F.col(c) < 0, "negative").otherwise("zero"))


def product_sign_matrix(wh) -> DataFrame:
    """Product lines by cancellation flag × sign(quantity) × sign(price)."""
    s = wh.table("silver_transactions").filter(F.col("line_category") == "product")
    return (s.groupBy("is_cancellation", _sign(S.QUANTITY).alias("quantity_sign"),
                      _sign(S.PRICE).alias("price_sign"))
             .agg(F.count(F.lit(1)).alias("rows"), rounded_money(F.sum("raw_line_value")).alias("raw_value"))
             .orderBy(F.col("rows").desc(), "is_cancellation", "quantity_sign", "price_sign"))


def product_scope(wh) -> DataFrame:
    """The scope check; its net is all priced product lines (own definition)."""
    s = wh.table("silver_transactions")
    product = F.col("line_category") == "product"
    sale = product & ~F.col("is_cancellation") & (F.col(S.QUANTITY) > 0) & (F.col(S.PRICE) > 0)
    cancel = product & F.col("is_cancellation") & (F.col(S.QUANTITY) < 0) & (F.col(S.PRICE) > 0)
    zero = F.lit(0).cast("decimal(38,4)")
    val = lambda cond: F.sum(F.when(cond, F.col("raw_line_value")).otherwise(zero))
    return s.agg(
        count_when(sale).alias("product_sale_rows"),
        count_when(cancel).alias("product_cancellation_rows"),
        rounded_money(val(sale)).alias("gross_product_sales"),
        rounded_money(val(cancel)).alias("product_cancellations"),
        rounded_money(val(product & (F.col(S.PRICE) > 0))).alias("net_product_sales"),
    )


EXAMPLE_COLUMNS = [S.INVOICE, S.STOCK_CODE, S.DESCRIPTION, S.QUANTITY, S.PRICE, "line_category",
                   "is_cancellation", "is_product_sale", "is_product_cancellation"]
_EXAMPLE_ORDER = [S.INVOICE_DATE, S.INVOICE, S.STOCK_CODE, S.DESCRIPTION, S.QUANTITY, S.PRICE]


def line_type_examples(wh) -> DataFrame:
    """5 sale lines ∪ 5 cancellation lines ∪ 10 non-product lines (first in time), in
    one read of the lines."""
    order = tuple((c, True) for c in _EXAMPLE_ORDER)
    lists = [TopList("product_sale", F.col("is_product_sale"), order, 5),
             TopList("product_cancellation", F.col("is_product_cancellation"), order, 5),
             TopList("other_category", F.col("line_category") != "product", order, 10)]
    first = top_lists(wh.table("fact_order_lines"), lists, [*EXAMPLE_COLUMNS, "net_product_sales_value"])
    return first.select(F.col("list_name").alias("line_type"), *EXAMPLE_COLUMNS,
                        money("net_product_sales_value").alias("net_product_sales_value"))


def _compute_order_lists(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    lists = [TopList("largest_orders", F.col("has_product_sale"), (("gross_product_sales_value", False), (S.INVOICE, True)), SAMPLE_ROWS),
             TopList("largest_cancellations", F.col("has_product_cancellation"), (("product_cancellation_value", True), (S.INVOICE, True)),
                     SAMPLE_ROWS),
             TopList("first_orders", F.lit(True), (("order_datetime", True), (S.INVOICE, True)), SAMPLE_ROWS)]
    return top_lists(fo, lists, fo.columns)


def _order_list(wh, name: str) -> DataFrame:
    """One of the three order lists, which one read of the orders gives; stored."""
    derived = getattr(wh, "derived", None)
    lists = derived("order_lists", _compute_order_lists) if derived else _compute_order_lists(wh)
    return lists.where(F.col("list_name") == name).orderBy("rank").drop("list_name", "rank")


def largest_orders(wh) -> DataFrame:
    """purchase invoices with the largest gross value."""
    return _order_list(wh, "largest_orders").select(
        S.INVOICE, "order_datetime", "customer_id", "country", "line_count", "distinct_stockcodes", "product_sale_quantity",
        money("gross_product_sales_value").alias("gross_product_sales_value"),
        money("product_cancellation_value").alias("product_cancellation_value"),
        money("net_product_sales_value").alias("net_product_sales_value"),
        "is_cancellation", "has_product_sale", "has_product_cancellation")


def largest_cancellations(wh) -> DataFrame:
    """invoices with the most negative product cancellation value."""
    return _order_list(wh, "largest_cancellations").select(
        S.INVOICE, "order_datetime", "customer_id", "country", "line_count", "product_cancellation_quantity",
        money("product_cancellation_value").alias("product_cancellation_value"), "is_cancellation", "has_product_cancellation")


def first_orders(wh) -> DataFrame:
    """order sample, earliest first (ties by invoice)."""
    orders = _order_list(wh, "first_orders")
    amounts = ["raw_order_value", "gross_product_sales_value", "product_cancellation_value", "net_product_sales_value"]
    return orders.select(*[money(c).alias(c) if c in amounts else F.col(c) for c in orders.columns])


def first_customers(wh, n: int = SAMPLE_ROWS) -> DataFrame:
    """dimension sample, earliest customers first."""
    return wh.table("dim_customers").orderBy("first_activity_datetime", "customer_id").limit(n)


def products_sample(wh, n: int = SAMPLE_ROWS) -> DataFrame:
    """dimension sample by code."""
    return wh.table("dim_products").orderBy("stock_code").limit(n)


def multi_description_products(wh, n: int = SAMPLE_ROWS) -> DataFrame:
    """codes with the most distinct descriptions."""
    dp = wh.table("dim_products").filter(F.col("distinct_descriptions") > 1)
    return (dp.select("stock_code", "product_description", "line_category", "distinct_descriptions")
              .orderBy(F.col("distinct_descriptions").desc(), "stock_code").limit(n))
