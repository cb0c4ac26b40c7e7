"""Sales, product, country and calendar reports (dashboard + analysis).

Each function takes a ``Warehouse`` and returns a DataFrame.  Aggregations
are partial (map-side) before their shuffle; product reports aggregate by
code first and join the product dimension (unique per code) afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import calendar as CAL
from tillroll.functions.numeric import count_when, money, round2, rounded_money, safe_div
from tillroll.functions.scoring import MISSING_DESCRIPTION_LABEL
from tillroll.operators.quantiles import describe, tail_histogram

DEFAULT_COUNTRY = "EIRE"
DEFAULT_YEARS = (1999, 2000)
TOP_N = 10
TAIL = 0.99

def _sale() -> Column:
    return F.col("has_product_sale")


def _cancel() -> Column:
    return F.col("has_product_cancellation")


def _sum(c: str) -> Column:
    return F.sum(c)


def purchasing_customers() -> Column:
    return F.countDistinct(F.when(_sale() & F.col("customer_id").isNotNull(), F.col("customer_id")))


# --------------------------------------------------------------- dashboard --

def kpi_executive(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    return fo.agg(
        money(_sum("net_product_sales_value")).alias("net_sales"),
        count_when(_sale()).alias("purchase_orders"),
        safe_div(_sum("gross_product_sales_value"), count_when(_sale())).alias("average_order_value"),
        F.countDistinct(F.when(_sale(), F.col("customer_id"))).alias("customers"),
    )


def monthly_totals(orders: DataFrame) -> DataFrame:
    """Exact totals of the orders of each month."""
    return orders.groupBy(CAL.month_start("order_datetime").alias("month")).agg(
        _sum("gross_product_sales_value").alias("_gross"),
        _sum("product_cancellation_value").alias("_cancel"),
        _sum("net_product_sales_value").alias("_net"),
        count_when(_sale()).alias("_purchases"),
        count_when(_cancel()).alias("_cancellations"),
        purchasing_customers().alias("_customers"))


def _compute_monthly_orders(wh) -> DataFrame:
    return monthly_totals(wh.table("fact_orders"))


def _monthly_orders(wh) -> DataFrame:
    """Exact monthly totals of the orders (one row per month), stored once:
    the four monthly reports read them."""
    derived = getattr(wh, "derived", None)
    return derived("monthly_orders", _compute_monthly_orders) if derived else _compute_monthly_orders(wh)


def monthly_sales(wh) -> DataFrame:
    m = _monthly_orders(wh)
    return (m.select("month", money("_net").alias("net_sales"), F.col("_purchases").alias("purchase_orders"))
              .orderBy("month"))


def top_countries(wh, n: int = TOP_N) -> DataFrame:
    fo = wh.table("fact_orders")
    agg = fo.groupBy("country").agg(_sum("net_product_sales_value").alias("_net"))
    return (agg.orderBy(F.col("_net").desc(), F.col("country").asc_nulls_last()).limit(n)
               .select("country", money("_net").alias("net_sales")))


def kpi_sales(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    return fo.agg(
        money(_sum("gross_product_sales_value")).alias("gross_sales"),
        money(-_sum("product_cancellation_value")).alias("cancellations"),
        safe_div(-_sum("product_cancellation_value"), _sum("gross_product_sales_value")).alias("cancellation_rate"),
        F.countDistinct(F.when(_cancel(), F.col(S.INVOICE))).alias("cancellation_invoices"),
    )


def monthly_cancel_rate(wh) -> DataFrame:
    m = _monthly_orders(wh)
    return (m.select("month", (money("_gross") / F.lit(1000000.0)).alias("gross_sales_m"),
                     safe_div(F.lit(100.0) * money(-F.col("_cancel")), "_gross").alias("cancellation_rate"))
              .orderBy("month"))


def _product_totals(wh, lines: DataFrame) -> DataFrame:
    """Aggregate per code first, then attach the (unique per code) dimension."""
    per_code = lines.groupBy(S.STOCK_CODE).agg(
        _sum("gross_product_sales_value").alias("_gross"),
        _sum("product_cancellation_value").alias("_cancel"),
        _sum("net_product_sales_value").alias("_net"),
        F.sum(F.when(F.col("is_product_sale"), F.col(S.QUANTITY)).otherwise(0)).cast("bigint").alias("quantity_sold"))
    dp = wh.table("dim_products").select(F.col("stock_code").alias(S.STOCK_CODE), "product_description")
    return per_code.join(dp, S.STOCK_CODE, "left")


def _compute_product_totals(wh) -> DataFrame:
    return _product_totals(wh, wh.table("fact_order_lines").filter(F.col("line_category") == "product"))


def _all_product_totals(wh) -> DataFrame:
    """Per-code totals of all product lines, stored once: four reports read them."""
    derived = getattr(wh, "derived", None)
    return derived("product_totals", _compute_product_totals) if derived else _compute_product_totals(wh)


def product_performance(wh) -> DataFrame:
    """A13 + F5: every product line code, sorted by net sales."""
    t = _all_product_totals(wh)
    return (t.select(F.col(S.STOCK_CODE).alias("stock_code"),
                     F.coalesce(F.col("product_description"), F.col(S.STOCK_CODE)).alias("product_description"),
                     money("_gross").alias("gross_sales"),
                     money(-F.col("_cancel")).alias("cancellation_value"),
                     money("_net").alias("net_sales"),
                     F.col("_net"))
             .orderBy(F.col("_net").desc(), F.col("stock_code")).drop("_net"))


def _top_products(wh, measure: str, n: int) -> DataFrame:
    t = _all_product_totals(wh).withColumn("_cancel_pos", -F.col("_cancel"))
    key = {"net_sales": "_net", "cancellation_value": "_cancel_pos"}[measure]
    return (t.orderBy(F.col(key).desc(), F.col(S.STOCK_CODE)).limit(n)
             .select(F.col(S.STOCK_CODE).alias("stock_code"),
                     F.coalesce(F.col("product_description"), F.col(S.STOCK_CODE)).alias("product"),
                     money("_gross").alias("gross_sales"),
                     money(-F.col("_cancel")).alias("cancellation_value"),
                     money("_net").alias("net_sales")))


def top_products_net(wh, n: int = TOP_N) -> DataFrame:
    return _top_products(wh, "net_sales", n)


def top_products_cancel(wh, n: int = TOP_N) -> DataFrame:
    return _top_products(wh, "cancellation_value", n)


def country_list(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    return fo.select("country").filter(F.col("country").isNotNull()).distinct().orderBy("country")


_BY_COUNTRY = """
SELECT t.code AS stock_code, coalesce(p.product_description, t.code) AS product_description,
  CAST(round(t.gross, 2) AS DOUBLE) AS gross_sales, CAST(round(-t.cancelled, 2) AS DOUBLE) AS cancellation_value,
  CAST(round(t.net, 2) AS DOUBLE) AS net_sales
FROM (
  SELECT StockCode AS code, sum(gross_product_sales_value) AS gross, sum(product_cancellation_value) AS cancelled,
    sum(net_product_sales_value) AS net
  FROM {lines} WHERE line_category = 'product' AND Country = :country GROUP BY StockCode) t
LEFT JOIN {products} p ON p.stock_code = t.code
ORDER BY net_sales DESC, stock_code"""


def product_by_country(wh, country: str = DEFAULT_COUNTRY) -> DataFrame:
    """A14 + fn17: the product explorer for one country, a bound parameter of the statement:
    its value is compared, never parsed, and the filter reaches the scan."""
    return wh.spark.sql(_BY_COUNTRY, args={"country": country}, lines=wh.table("fact_order_lines"), products=wh.table("dim_products"))


# ---------------------------------------------------------------- analysis --

def _kpi_columns() -> list[Column]:
    return [
        rounded_money(_sum("gross_product_sales_value")).alias("gross_product_sales"),
        rounded_money(_sum("product_cancellation_value")).alias("product_cancellations"),
        rounded_money(_sum("net_product_sales_value")).alias("net_product_sales"),
        count_when(_sale()).alias("purchase_invoices"),
    ]


def _avg_order_value() -> Column:
    return round2(safe_div(_sum("gross_product_sales_value"), count_when(_sale())))


def business_kpis(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    c = _kpi_columns()
    return fo.agg(*c[:4], count_when(_cancel()).alias("cancellation_invoices"),
                  purchasing_customers().alias("identified_purchasing_customers"),
                  _avg_order_value().alias("average_gross_order_value"))


BUSINESS_KPI_NAMES = ["gross_product_sales", "product_cancellations", "net_product_sales",
                      "purchase_invoices", "cancellation_invoices",
                      "identified_purchasing_customers", "average_gross_order_value"]


def business_kpis_long(wh) -> DataFrame:
    """The KPI row transposed to (KPI, Value)."""
    row = business_kpis(wh).select(*[F.col(k).cast("double").alias(k) for k in BUSINESS_KPI_NAMES])
    return row.unpivot([], BUSINESS_KPI_NAMES, "KPI", "Value")


def monthly_performance(wh) -> DataFrame:
    return _performance(_monthly_orders(wh))


def _performance(totals: DataFrame) -> DataFrame:
    m = totals.select(
        "month", rounded_money("_gross").alias("gross_product_sales"),
        rounded_money("_cancel").alias("product_cancellations"),
        rounded_money("_net").alias("net_product_sales"),
        F.col("_purchases").alias("purchase_invoices"),
        F.col("_customers").alias("active_identified_customers"))
    return (m.withColumn("average_order_value", safe_div(F.col("gross_product_sales"), F.col("purchase_invoices")))
             .orderBy("month"))


def country_performance(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    return (fo.groupBy("country")
              .agg(rounded_money(_sum("net_product_sales_value")).alias("net_product_sales"),
                   count_when(_sale()).alias("purchase_invoices"),
                   purchasing_customers().alias("identified_customers"),
                   _sum("net_product_sales_value").alias("_net"))
              .filter(F.col("_net") > 0).drop("_net")
              .orderBy(F.col("net_product_sales").desc(), "country"))


def _label(code: str, desc: str) -> Column:
    return F.concat(F.col(code), F.lit(" - "), F.coalesce(F.col(desc), F.lit(MISSING_DESCRIPTION_LABEL)))


def product_ranking(wh) -> DataFrame:
    """A19 + F6: product codes with positive net value, with chart label."""
    return (_all_product_totals(wh).filter(F.col("_net") > 0)
            .select(F.col(S.STOCK_CODE).alias("stock_code"), "product_description", "quantity_sold",
                    rounded_money("_gross").alias("gross_product_sales"),
                    rounded_money("_net").alias("net_product_sales"))
            .withColumn("label", _label("stock_code", "product_description"))
            .orderBy(F.col("net_product_sales").desc(), "stock_code"))


def top_country_performance(wh, n: int = 10) -> DataFrame:
    """A18 + F6: the first ``n`` countries by net value (take-ordered, no full sort)."""
    return country_performance(wh).limit(n)


def top_product_ranking(wh, n: int = 15) -> DataFrame:
    """A19 + F6: the first ``n`` products by net value."""
    return product_ranking(wh).limit(n)


def top_product_cancellations(wh, n: int = 15) -> DataFrame:
    """A25 + F6: the first ``n`` products by cancelled value."""
    return product_cancellations(wh).limit(n)


def _year_range(years) -> Column:
    """The same rows as ``year IN years``, stated on the raw timestamp so the
    Parquet scan can skip row groups (min/max statistics)."""
    lo = F.lit(f"{min(years)}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{max(years) + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col("order_datetime") >= lo) & (F.col("order_datetime") < hi)


def year_comparison(wh, years=DEFAULT_YEARS) -> DataFrame:
    fo = wh.orders_between(min(years), max(years)).filter(_year_range(years))
    y = CAL.year_of("order_datetime")
    return (fo.filter(y.isin(list(years)) & (CAL.month_of("order_datetime") <= 11))
              .groupBy(y.alias("year"))
              .agg(*_kpi_columns(), purchasing_customers().alias("active_identified_customers"),
                   _avg_order_value().alias("average_order_value"))
              .orderBy("year"))


YEAR_CHANGE_KPIS = [("Net product sales", "net_product_sales"),
                    ("Purchase invoices", "purchase_invoices"),
                    ("Active identified customers", "active_identified_customers"),
                    ("Average order value", "average_order_value")]


def year_change(wh, years=DEFAULT_YEARS) -> DataFrame:
    """KPI × (first year, second year) and change %, rounded half-even."""
    a, b = years
    yc = year_comparison(wh, years)
    long = yc.select("year", *[F.col(c).cast("double").alias(c) for _, c in YEAR_CHANGE_KPIS]).unpivot(
        ["year"], [c for _, c in YEAR_CHANGE_KPIS], "kpi_column", "value")
    wide = long.groupBy("kpi_column").pivot("year", [a, b]).agg(F.first("value"))
    names = wh.spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(YEAR_CHANGE_KPIS)],
                                     "kpi_order int, KPI string, kpi_column string")
    out = F.broadcast(names).join(wide, "kpi_column", "left").select(
        "kpi_order", "KPI",
        F.col(str(a)).alias("value_first_year"),
        F.col(str(b)).alias("value_second_year"))
    change = (F.col("value_second_year") / F.col("value_first_year") - F.lit(1.0)) * F.lit(100.0)
    return (out.withColumn("change_pct", F.bround(change * 100, 0) / 100)
               .orderBy("kpi_order"))


def weekday_performance(wh) -> DataFrame:
    fo = wh.table("fact_orders")
    return (fo.groupBy(CAL.iso_weekday("order_datetime").alias("weekday_number"),
                       CAL.day_name("order_datetime").alias("weekday"))
              .agg(rounded_money(_sum("net_product_sales_value")).alias("net_product_sales"),
                   count_when(_sale()).alias("purchase_invoices"),
                   _avg_order_value().alias("average_order_value"))
              .orderBy("weekday_number"))


def saturday_check(wh) -> DataFrame:
    fo = wh.table("fact_orders").filter(CAL.iso_weekday("order_datetime") == 6)
    return fo.agg(F.count(F.lit(1)).alias("invoices"), count_when(_sale()).alias("purchase_invoices"),
                  rounded_money(_sum("gross_product_sales_value")).alias("gross_product_sales"),
                  F.min("order_datetime").alias("first_saturday"),
                  F.max("order_datetime").alias("last_saturday"))


def saturday_orders(wh) -> DataFrame:
    fo = wh.table("fact_orders").filter(CAL.iso_weekday("order_datetime") == 6)
    return (fo.select(S.INVOICE, "order_datetime", "customer_id", "country",
                      money("gross_product_sales_value").alias("gross_product_sales_value"),
                      money("net_product_sales_value").alias("net_product_sales_value"),
                      "has_product_sale", "is_cancellation")
              .orderBy("order_datetime", S.INVOICE))


def monthly_cancellations(wh) -> DataFrame:
    m = _monthly_orders(wh).select(
        "month", F.col("_purchases").alias("purchase_invoices"),
        F.col("_cancellations").alias("cancellation_invoices"),
        rounded_money("_gross").alias("gross_product_sales"),
        rounded_money(F.abs(F.col("_cancel"))).alias("cancellation_value"))
    return (m.withColumn("cancellation_invoice_ratio_pct",
                         safe_div("cancellation_invoices", "purchase_invoices") * 100)
             .withColumn("cancellation_value_ratio_pct",
                         safe_div("cancellation_value", "gross_product_sales") * 100)
             .orderBy("month"))


def product_cancellations(wh) -> DataFrame:
    """A25 + F6: cancelled product lines per code, with chart label."""
    fol = wh.table("fact_order_lines").filter(F.col("is_product_cancellation"))
    per_code = fol.groupBy(S.STOCK_CODE).agg(
        F.countDistinct(S.INVOICE).alias("cancellation_invoices"),
        F.abs(F.sum(S.QUANTITY)).cast("bigint").alias("cancelled_quantity"),
        rounded_money(F.abs(_sum("product_cancellation_value"))).alias("cancellation_value"))
    dp = wh.table("dim_products").select(F.col("stock_code").alias(S.STOCK_CODE), "product_description")
    return (per_code.join(dp, S.STOCK_CODE, "left")
            .select(F.col(S.STOCK_CODE).alias("stock_code"), "product_description",
                    "cancellation_invoices", "cancelled_quantity", "cancellation_value")
            .withColumn("label", _label("stock_code", "product_description"))
            .orderBy(F.col("cancellation_value").desc(), "stock_code"))


# ------------------------------------------------------ order distributions --

def _purchase_orders(wh) -> DataFrame:
    """F8: orders with a sale and a positive gross value."""
    fo = wh.table("fact_orders")
    return fo.filter(F.col("has_product_sale") & (F.col("gross_product_sales_value") > 0)).select(
        S.INVOICE, "distinct_stockcodes", "product_sale_quantity", "gross_product_sales_value")


def order_value_stats(wh) -> DataFrame:
    """describe() of the gross value of purchase orders."""
    return describe(_purchase_orders(wh), ["gross_product_sales_value"])


def order_size_stats(wh) -> DataFrame:
    """describe() of order size (codes, quantity) and value."""
    return describe(_purchase_orders(wh), ["distinct_stockcodes", "product_sale_quantity",
                                           "gross_product_sales_value"])


def order_value_histogram(wh, bins: int = 50) -> DataFrame:
    """A30 + A31: the 99 % cut, then equal-width bins of the values at or below it."""
    return tail_histogram(_purchase_orders(wh), "gross_product_sales_value", bins, TAIL)


def order_size_histogram(wh, bins: int = 40) -> DataFrame:
    """A30 + A31: the same for the number of codes in an order."""
    return tail_histogram(_purchase_orders(wh), "distinct_stockcodes", bins, TAIL)
