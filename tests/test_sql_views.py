"""The layers as SQL views: dashboard-style SQL runs unchanged in Spark SQL
(FILTER clauses, ordinals in GROUP BY, HAVING on an alias, a bound parameter)."""

from __future__ import annotations

from tillroll.plans import customers, sales


def test_views_answer_like_the_dataframe_queries(spark, wh_check):
    names = wh_check.register_views(prefix="t_")
    assert "t_fact_orders" in names and "t_stockcode_categories" in names
    row = spark.sql("""
        SELECT CAST(SUM(net_product_sales_value) AS DOUBLE) AS net_sales,
               COUNT(*) FILTER (WHERE has_product_sale) AS purchase_orders,
               COUNT(DISTINCT customer_id) FILTER (WHERE has_product_sale) AS customers
        FROM t_fact_orders""").collect()[0]
    ref = sales.kpi_executive(wh_check).collect()[0]
    assert (row["net_sales"], row["purchase_orders"], row["customers"]) == \
           (ref["net_sales"], ref["purchase_orders"], ref["customers"])

    freq = spark.sql("""
        SELECT customer_id, SUM(CASE WHEN has_product_sale THEN 1 ELSE 0 END) AS purchase_count
        FROM t_fact_orders WHERE customer_id IS NOT NULL
        GROUP BY 1 HAVING purchase_count > 0""")
    assert freq.count() == customers.customer_frequency(wh_check).count()

    by_country = spark.sql("""
        SELECT fol.StockCode AS stock_code, ROUND(SUM(fol.net_product_sales_value), 2) AS net_sales
        FROM t_fact_order_lines fol
        WHERE fol.line_category = 'product' AND fol.Country = ?
        GROUP BY fol.StockCode""", args=[sales.DEFAULT_COUNTRY])
    assert by_country.count() == sales.product_by_country(wh_check).count()
