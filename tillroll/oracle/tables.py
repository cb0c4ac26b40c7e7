"""DuckDB oracle SQL for ``plans.tables`` (money leaves as DOUBLE, as the Spark output edge does)."""

SQL = {
    "ingest_consolidated": "SELECT * REPLACE (CAST(Price AS DOUBLE) AS Price) FROM bronze",
    "bronze_summary": """
SELECT COUNT(*) AS row_count, CAST(9 AS BIGINT) AS column_count,
  MIN(InvoiceDate) AS first_invoice_date, MAX(InvoiceDate) AS last_invoice_date
FROM bronze""",
    "silver_lines": """
SELECT * REPLACE (CAST(Price AS DOUBLE) AS Price, CAST(raw_line_value AS DOUBLE) AS raw_line_value)
FROM silver""",
    "fact_order_lines": """
SELECT * REPLACE (CAST(Price AS DOUBLE) AS Price, CAST(raw_line_value AS DOUBLE) AS raw_line_value,
  CAST(gross_product_sales_value AS DOUBLE) AS gross_product_sales_value,
  CAST(product_cancellation_value AS DOUBLE) AS product_cancellation_value,
  CAST(net_product_sales_value AS DOUBLE) AS net_product_sales_value)
FROM fol""",
    "fact_orders": """
SELECT * REPLACE (CAST(raw_order_value AS DOUBLE) AS raw_order_value,
  CAST(gross_product_sales_value AS DOUBLE) AS gross_product_sales_value,
  CAST(product_cancellation_value AS DOUBLE) AS product_cancellation_value,
  CAST(net_product_sales_value AS DOUBLE) AS net_product_sales_value)
FROM fo""",
    "dim_customers": "SELECT * FROM dc",
    "dim_products": "SELECT * FROM dp",
    "customer_rfm": "SELECT * FROM rfm",
}
