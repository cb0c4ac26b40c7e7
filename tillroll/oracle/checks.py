"""DuckDB oracle SQL for ``plans.checks``."""

_PROFILE = """
SELECT COUNT(*) AS {p}_rows, CAST(SUM(Quantity) AS BIGINT) AS {p}_total_quantity,
  SUM(Price) AS {p}_total_price_exact,
  CAST(SUM(CASE WHEN customer_id_raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {p}_missing_customer,
  MIN(InvoiceDate) AS {p}_min_date, MAX(InvoiceDate) AS {p}_max_date
FROM {t}"""

_FLAGS = ["is_cancellation", "is_negative_quantity", "is_zero_price", "is_negative_price",
          "is_missing_customer", "is_missing_description", "is_special_stockcode", "is_repeated_row"]

SQL = {
    "check_stored_metrics": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows, true AS metrics_match FROM {cte}" for name, cte in (
            ("bronze", "bronze"), ("dim_customers", "dc"), ("dim_products", "dp"), ("fact_order_lines", "fol"), ("fact_orders", "fo"),
            ("silver_transactions", "silver"))),
    "check_bronze": f"""
SELECT a.source_rows, a.source_total_quantity, a.source_missing_customer, a.source_min_date, a.source_max_date,
  b.bronze_rows, b.bronze_total_quantity, b.bronze_missing_customer, b.bronze_min_date, b.bronze_max_date,
  CAST(a.source_total_price_exact AS DOUBLE) AS source_total_price,
  CAST(b.bronze_total_price_exact AS DOUBLE) AS bronze_total_price,
  (a.source_rows = b.bronze_rows AND a.source_total_quantity = b.bronze_total_quantity
   AND ABS(a.source_total_price_exact - b.bronze_total_price_exact) < 0.01
   AND a.source_missing_customer = b.bronze_missing_customer
   AND a.source_min_date = b.bronze_min_date AND a.source_max_date = b.bronze_max_date) AS bronze_is_valid
FROM ({_PROFILE.format(p='source', t='(SELECT * FROM raw_a WHERE InvoiceDate < TIMESTAMP ' + "'1998-12-01 00:00:00'" + ' UNION ALL SELECT * FROM raw_b) u')}) a
CROSS JOIN ({_PROFILE.format(p='bronze', t='bronze')}) b""",
    "check_silver_flags": "SELECT COUNT(*) AS rows, CAST(19 AS BIGINT) AS columns, "
                          + ", ".join(f"CAST(SUM(CASE WHEN {f} THEN 1 ELSE 0 END) AS BIGINT) AS {f}" for f in _FLAGS)
                          + " FROM silver",
    "check_categories": """
SELECT COUNT(CASE WHEN r.stock_code IS NOT NULL THEN 1 END) AS special_rows,
  COUNT(DISTINCT CASE WHEN r.stock_code IS NOT NULL THEN s.StockCode END) AS special_codes,
  COUNT(CASE WHEN s.line_category IS NULL THEN 1 END) AS missing_categories
FROM silver s LEFT JOIN categories r ON s.StockCode = r.stock_code""",
    "category_counts": """
SELECT line_category, COUNT(*) AS rows FROM silver GROUP BY line_category ORDER BY rows DESC, line_category""",
    "check_order_lines": """
SELECT COUNT(*) AS rows,
  CAST(SUM(CASE WHEN is_product_sale THEN 1 ELSE 0 END) AS BIGINT) AS product_sale_rows,
  CAST(SUM(CASE WHEN is_product_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS product_cancellation_rows,
  CAST(ROUND(SUM(gross_product_sales_value), 2) AS DOUBLE) AS gross_product_sales,
  CAST(ROUND(SUM(product_cancellation_value), 2) AS DOUBLE) AS product_cancellations,
  CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales
FROM fol""",
    "check_orders": """
SELECT o.*, l.expected_orders, o.orders = l.expected_orders AS grain_valid FROM (
  SELECT COUNT(*) AS orders,
    CAST(ROUND(SUM(gross_product_sales_value), 2) AS DOUBLE) AS gross_product_sales,
    CAST(ROUND(SUM(product_cancellation_value), 2) AS DOUBLE) AS product_cancellations,
    CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales
  FROM fo) o
CROSS JOIN (SELECT COUNT(DISTINCT Invoice) AS expected_orders FROM fol) l""",
    "check_customers": """
SELECT COUNT(*) AS customers, COUNT(DISTINCT customer_id) AS distinct_customers,
  CAST(SUM(CASE WHEN is_multi_country THEN 1 ELSE 0 END) AS BIGINT) AS multi_country_customers,
  MIN(first_activity_datetime) AS first_activity, MAX(last_activity_datetime) AS last_activity,
  COUNT(*) = COUNT(DISTINCT customer_id) AS grain_valid
FROM dc""",
    "check_products": """
SELECT COUNT(*) AS products, COUNT(DISTINCT stock_code) AS distinct_stock_codes,
  CAST(SUM(CASE WHEN product_description IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_descriptions,
  CAST(SUM(CASE WHEN distinct_descriptions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multiple_description_codes,
  COUNT(*) = COUNT(DISTINCT stock_code) AS grain_valid
FROM dp""",
}
