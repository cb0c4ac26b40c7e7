"""DuckDB oracle SQL for ``plans.sales`` (bodies; CTEs are added by ``base.with_ctes``)."""

from tillroll.oracle.stats import describe_sql, histogram_sql, quantiles_sql
from tillroll.plans.sales import DEFAULT_COUNTRY, DEFAULT_YEARS

_ORDERS = "count(*) FILTER (has_product_sale)"
_PC = "count(DISTINCT customer_id) FILTER (has_product_sale)"
_AOV = f"round(sum(gross_product_sales_value)::DOUBLE / nullif({_ORDERS}, 0)::DOUBLE * 100) / 100"
_KPI = f"""{_ORDERS} AS purchase_invoices, round(sum(gross_product_sales_value), 2)::DOUBLE AS gross_product_sales,
  round(sum(net_product_sales_value), 2)::DOUBLE AS net_product_sales,
  round(sum(product_cancellation_value), 2)::DOUBLE AS product_cancellations"""
_MONTH = "CAST(DATE_TRUNC('month', order_datetime) AS TIMESTAMP)"



def _per_code(which: str = "line_category = 'product'") -> str:
    """Totals per code of some lines, then the code's name from the product dimension."""
    return f"""(
  SELECT t.*, (SELECT any_value(product_description) FROM dp WHERE dp.stock_code = t.code) AS name
  FROM (SELECT StockCode AS code, sum(net_product_sales_value) AS net, sum(gross_product_sales_value) AS gross,
          sum(product_cancellation_value) AS cancelled, sum(Quantity) FILTER (is_product_sale) AS sold,
          sum(Quantity) AS quantity, count(DISTINCT Invoice) AS invoices
        FROM fol WHERE {which} GROUP BY StockCode) t)"""


_LABEL = "concat_ws(' - ', code, coalesce(name, 'Description manquante'))"
_MEASURES = "net::DOUBLE AS net_sales, gross::DOUBLE AS gross_sales, (-cancelled)::DOUBLE AS cancellation_value"

SQL = {
    "kpi_executive": f"""
SELECT CAST(SUM(net_product_sales_value) AS DOUBLE) AS net_sales,
  COUNT(*) FILTER (WHERE has_product_sale) AS purchase_orders,
  CAST(SUM(gross_product_sales_value) AS DOUBLE)
    / CAST(NULLIF(COUNT(*) FILTER (WHERE has_product_sale), 0) AS DOUBLE) AS average_order_value,
  COUNT(DISTINCT customer_id) FILTER (WHERE has_product_sale) AS customers
FROM fo""",
    "monthly_sales": f"""
SELECT {_MONTH} AS month, CAST(SUM(net_product_sales_value) AS DOUBLE) AS net_sales,
  COUNT(*) FILTER (WHERE has_product_sale) AS purchase_orders
FROM fo GROUP BY 1 ORDER BY 1""",
    "top_countries": """
SELECT country, CAST(SUM(net_product_sales_value) AS DOUBLE) AS net_sales
FROM fo GROUP BY country
ORDER BY SUM(net_product_sales_value) DESC, country ASC NULLS LAST LIMIT 10""",
    "kpi_sales": """
SELECT CAST(SUM(gross_product_sales_value) AS DOUBLE) AS gross_sales,
  CAST(-SUM(product_cancellation_value) AS DOUBLE) AS cancellations,
  CAST(-SUM(product_cancellation_value) AS DOUBLE)
    / CAST(NULLIF(SUM(gross_product_sales_value), 0) AS DOUBLE) AS cancellation_rate,
  COUNT(DISTINCT Invoice) FILTER (WHERE has_product_cancellation) AS cancellation_invoices
FROM fo""",
    "monthly_cancel_rate": f"""
SELECT {_MONTH} AS month,
  CAST(SUM(gross_product_sales_value) AS DOUBLE) / 1000000.0 AS gross_sales_m,
  (100.0 * CAST(-SUM(product_cancellation_value) AS DOUBLE))
    / CAST(NULLIF(SUM(gross_product_sales_value), 0) AS DOUBLE) AS cancellation_rate
FROM fo GROUP BY 1 ORDER BY 1""",
    "product_performance": f"""
SELECT code AS stock_code, coalesce(name, code) AS product_description, {_MEASURES} FROM {_per_code()} ORDER BY net DESC, code""",
    "top_products_net": f"""
SELECT code AS stock_code, coalesce(name, code) AS product, {_MEASURES} FROM {_per_code()} ORDER BY net DESC, code LIMIT 10""",
    "top_products_cancel": f"""
SELECT code AS stock_code, coalesce(name, code) AS product, {_MEASURES} FROM {_per_code()} ORDER BY cancelled, code LIMIT 10""",
    "country_list": """
SELECT DISTINCT country FROM fo WHERE country IS NOT NULL ORDER BY country""",
    "product_by_country": f"""
SELECT code AS stock_code, coalesce(name, code) AS product_description, round(net, 2)::DOUBLE AS net_sales,
  round(gross, 2)::DOUBLE AS gross_sales, round(-cancelled, 2)::DOUBLE AS cancellation_value
FROM {_per_code(f"line_category = 'product' AND Country = '{DEFAULT_COUNTRY}'")} ORDER BY net_sales DESC, code""",
    "business_kpis": f"""
SELECT {_KPI},
  CAST(SUM(CASE WHEN has_product_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_invoices,
  {_PC} AS identified_purchasing_customers,
  {_AOV} AS average_gross_order_value
FROM fo""",
    "business_kpis_long": f"""
SELECT KPI, Value FROM (
  SELECT {_KPI},
    CAST(SUM(CASE WHEN has_product_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_invoices,
    {_PC} AS identified_purchasing_customers,
    {_AOV} AS average_gross_order_value
  FROM fo) k
UNPIVOT (Value FOR KPI IN (gross_product_sales, product_cancellations, net_product_sales,
  purchase_invoices, cancellation_invoices, identified_purchasing_customers, average_gross_order_value))""",
    "monthly_performance": f"""
SELECT *, gross_product_sales / CAST(NULLIF(purchase_invoices, 0) AS DOUBLE) AS average_order_value FROM (
  SELECT {_MONTH} AS month, {_KPI}, {_PC} AS active_identified_customers
  FROM fo GROUP BY 1) m ORDER BY month""",
    "country_performance": f"""
SELECT country, CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales,
  {_ORDERS} AS purchase_invoices, {_PC} AS identified_customers
FROM fo GROUP BY country HAVING SUM(net_product_sales_value) > 0
ORDER BY net_product_sales DESC, country""",
    "product_ranking": f"""
SELECT code AS stock_code, name AS product_description, {_LABEL} AS label, coalesce(sold, 0)::BIGINT AS quantity_sold,
  round(net, 2)::DOUBLE AS net_product_sales, round(gross, 2)::DOUBLE AS gross_product_sales
FROM {_per_code()} WHERE net > 0 ORDER BY net_product_sales DESC, stock_code""",
    "year_comparison": f"""
SELECT CAST(EXTRACT(YEAR FROM order_datetime) AS INTEGER) AS year, {_KPI},
  {_PC} AS active_identified_customers, {_AOV} AS average_order_value
FROM fo
WHERE EXTRACT(YEAR FROM order_datetime) IN {tuple(DEFAULT_YEARS)}
  AND EXTRACT(MONTH FROM order_datetime) <= 11
GROUP BY 1 ORDER BY 1""",
    "year_change": f"""
WITH yc AS (
  SELECT CAST(EXTRACT(YEAR FROM order_datetime) AS INTEGER) AS year,
    CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales,
    {_ORDERS}::DOUBLE AS purchase_invoices,
    CAST({_PC} AS DOUBLE) AS active_identified_customers,
    {_AOV} AS average_order_value
  FROM fo
  WHERE EXTRACT(YEAR FROM order_datetime) IN {tuple(DEFAULT_YEARS)}
    AND EXTRACT(MONTH FROM order_datetime) <= 11
  GROUP BY 1),
k AS (SELECT * FROM (VALUES (0, 'Net product sales', 'net_product_sales'),
  (1, 'Purchase invoices', 'purchase_invoices'),
  (2, 'Active identified customers', 'active_identified_customers'),
  (3, 'Average order value', 'average_order_value')) t(kpi_order, KPI, kpi_column)),
l AS (SELECT year, kpi_column, value FROM yc UNPIVOT (value FOR kpi_column IN
  (net_product_sales, purchase_invoices, active_identified_customers, average_order_value)))
SELECT k.kpi_order, k.KPI, a.value AS value_first_year, b.value AS value_second_year,
  ROUND_EVEN(((b.value / a.value - 1.0) * 100.0) * 100, 0) / 100 AS change_pct
FROM k
LEFT JOIN l a ON a.kpi_column = k.kpi_column AND a.year = {DEFAULT_YEARS[0]}
LEFT JOIN l b ON b.kpi_column = k.kpi_column AND b.year = {DEFAULT_YEARS[1]}
ORDER BY k.kpi_order""",
    "weekday_performance": f"""
SELECT CAST(EXTRACT('isodow' FROM order_datetime) AS BIGINT) AS weekday_number,
  DAYNAME(order_datetime) AS weekday,
  CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales,
  {_ORDERS} AS purchase_invoices, {_AOV} AS average_order_value
FROM fo GROUP BY weekday_number, weekday ORDER BY weekday_number""",
    "saturday_check": f"""
SELECT COUNT(*) AS invoices, {_ORDERS} AS purchase_invoices,
  CAST(ROUND(SUM(gross_product_sales_value), 2) AS DOUBLE) AS gross_product_sales,
  MIN(order_datetime) AS first_saturday, MAX(order_datetime) AS last_saturday
FROM fo WHERE EXTRACT('isodow' FROM order_datetime) = 6""",
    "saturday_orders": """
SELECT Invoice, order_datetime, customer_id, country,
  CAST(gross_product_sales_value AS DOUBLE) AS gross_product_sales_value,
  CAST(net_product_sales_value AS DOUBLE) AS net_product_sales_value,
  has_product_sale, is_cancellation
FROM fo WHERE EXTRACT('isodow' FROM order_datetime) = 6 ORDER BY order_datetime, Invoice""",
    "monthly_cancellations": f"""
SELECT *,
  CAST(cancellation_invoices AS DOUBLE) / CAST(NULLIF(purchase_invoices, 0) AS DOUBLE) * 100
    AS cancellation_invoice_ratio_pct,
  cancellation_value / NULLIF(gross_product_sales, 0) * 100 AS cancellation_value_ratio_pct
FROM (
  SELECT {_MONTH} AS month, {_ORDERS} AS purchase_invoices,
    CAST(SUM(CASE WHEN has_product_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_invoices,
    CAST(ROUND(SUM(gross_product_sales_value), 2) AS DOUBLE) AS gross_product_sales,
    CAST(ROUND(ABS(SUM(product_cancellation_value)), 2) AS DOUBLE) AS cancellation_value
  FROM fo GROUP BY 1) m ORDER BY month""",
    "product_cancellations": f"""
SELECT code AS stock_code, name AS product_description, {_LABEL} AS label, invoices AS cancellation_invoices,
  abs(quantity)::BIGINT AS cancelled_quantity, round(abs(cancelled), 2)::DOUBLE AS cancellation_value
FROM {_per_code("is_product_cancellation")} ORDER BY cancellation_value DESC, stock_code""",
}

_PURCHASE_ORDERS = ("SELECT Invoice, distinct_stockcodes, product_sale_quantity, gross_product_sales_value "
                    "FROM fo WHERE has_product_sale = TRUE AND gross_product_sales_value > 0")


def _tail_hist(col: str, bins: int) -> str:
    cut = quantiles_sql(_PURCHASE_ORDERS, col, [0.99])
    kept = f"SELECT p.{col} FROM ({_PURCHASE_ORDERS}) p WHERE CAST(p.{col} AS DOUBLE) <= (SELECT value FROM ({cut}) c)"
    return f"SELECT h.*, (SELECT value FROM ({cut}) c) AS cut_value FROM ({histogram_sql(kept, col, bins)}) h"


SQL.update({
    "order_value_stats": describe_sql(_PURCHASE_ORDERS, ["gross_product_sales_value"], 4),
    "order_size_stats": describe_sql(_PURCHASE_ORDERS, ["distinct_stockcodes", "product_sale_quantity",
                                                        "gross_product_sales_value"], 4),
    "order_value_histogram": _tail_hist("gross_product_sales_value", 50),
    "order_size_histogram": _tail_hist("distinct_stockcodes", 40),
})

# the same months, whatever batches their lines came in
SQL["monthly_performance_incremental"] = SQL["monthly_performance"]

# the first rows of the ordered reports
for _key, _of, _n in (("top_country_performance", "country_performance", 10), ("top_product_ranking", "product_ranking", 15),
                      ("top_product_cancellations", "product_cancellations", 15)):
    SQL[_key] = f"{SQL[_of]} LIMIT {_n}"
