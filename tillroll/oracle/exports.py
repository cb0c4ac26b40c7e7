"""DuckDB oracle SQL for ``plans.exports``, stated from the rules of the extracts."""

SQL = {
    # the order facts without the columns that stay in the warehouse, money as double
    "export_orders": """
SELECT Invoice AS invoice, * EXCLUDE (Invoice, last_line_datetime, source_period, total_quantity, raw_order_value)
  REPLACE (net_product_sales_value::DOUBLE AS net_product_sales_value, gross_product_sales_value::DOUBLE AS gross_product_sales_value,
           product_cancellation_value::DOUBLE AS product_cancellation_value)
FROM fo ORDER BY fo.order_datetime, fo.Invoice""",
    # one row an invoice first: a month's invoices are then its rows with a sale (or a return)
    "export_products_monthly": """
WITH on_invoice AS (
  SELECT date_trunc('month', InvoiceDate)::TIMESTAMP AS month, Country AS country, StockCode AS stock_code, Invoice,
    bool_or(is_product_sale) AS sells, bool_or(is_product_cancellation) AS returns,
    sum(Quantity) FILTER (is_product_sale) AS sold, sum(Quantity) FILTER (is_product_cancellation) AS returned,
    sum(net_product_sales_value) AS net, sum(gross_product_sales_value) AS gross, sum(product_cancellation_value) AS cancelled
  FROM fol WHERE line_category = 'product' GROUP BY ALL),
in_month AS (
  SELECT month, country, stock_code, count(Invoice) FILTER (sells) AS purchase_invoices, count(Invoice) FILTER (returns) AS cancellation_invoices,
    coalesce(sum(sold), 0)::BIGINT AS product_sale_quantity, coalesce(sum(returned), 0)::BIGINT AS product_cancellation_quantity,
    sum(net)::DOUBLE AS net_product_sales_value, sum(gross)::DOUBLE AS gross_product_sales_value,
    sum(cancelled)::DOUBLE AS product_cancellation_value
  FROM on_invoice GROUP BY ALL)
SELECT *, (SELECT any_value(product_description) FROM dp WHERE dp.stock_code = m.stock_code) AS product_description
FROM in_month m ORDER BY month, country, stock_code""",
}
