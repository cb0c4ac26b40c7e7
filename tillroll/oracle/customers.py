"""DuckDB oracle SQL for ``plans.customers``."""

from tillroll.oracle.stats import describe_sql

_M = "CAST(monetary AS DECIMAL(38,2))"
_SEG = f"""
SELECT segment, COUNT(*) AS customers,
  CAST(SUM(recency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS average_recency,
  CAST(SUM(frequency) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS average_frequency,
  CAST(SUM({_M}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS average_monetary,
  SUM({_M}) AS total_exact
FROM rfm GROUP BY segment"""

_CUSTOMER_VALUE = """
SELECT customer_id, ROUND(SUM(net_product_sales_value), 2) AS net_exact
FROM fo WHERE customer_id IS NOT NULL
GROUP BY customer_id HAVING SUM(net_product_sales_value) > 0"""

_PARETO = f"""
SELECT customer_id, net_exact,
  SUM(net_exact) OVER (ORDER BY net_exact DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
  SUM(net_exact) OVER () AS total,
  ROW_NUMBER() OVER (ORDER BY net_exact DESC, customer_id) AS pos,
  COUNT(*) OVER () AS n
FROM ({_CUSTOMER_VALUE}) cv"""

_PARETO_PCT = f"""
SELECT customer_id, net_exact, total,
  CAST(net_exact AS DOUBLE) AS net_product_sales,
  CAST(cum AS DOUBLE) AS cumulative_sales,
  CAST(cum AS DOUBLE) / CAST(NULLIF(total, 0) AS DOUBLE) * 100 AS cumulative_sales_pct,
  CAST(pos AS DOUBLE) / CAST(NULLIF(n, 0) AS DOUBLE) * 100 AS cumulative_customers_pct
FROM ({_PARETO}) p"""

_FREQ = """
SELECT customer_id, CAST(SUM(CASE WHEN has_product_sale THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count
FROM fo WHERE customer_id IS NOT NULL
GROUP BY customer_id HAVING purchase_count > 0"""

SQL = {
    "kpi_rfm": f"""
SELECT COUNT(*) AS rfm_customers,
  CAST(SUM(CASE WHEN segment = 'Champions' THEN 1 ELSE 0 END) AS BIGINT) AS champions,
  CAST(SUM(CASE WHEN segment = 'Champions' THEN {_M} END) AS DOUBLE)
    / CAST(NULLIF(SUM({_M}), 0) AS DOUBLE) AS champions_value_share,
  CAST(SUM(CASE WHEN segment = 'At Risk' THEN 1 ELSE 0 END) AS BIGINT) AS at_risk_customers
FROM rfm""",
    "segment_profile": f"""
SELECT segment, customers, average_recency, average_frequency, average_monetary,
  CAST(total_exact AS DOUBLE) AS total_monetary,
  CAST(total_exact AS DOUBLE) / CAST(NULLIF(SUM(total_exact) OVER (), 0) AS DOUBLE) AS value_share
FROM ({_SEG}) s ORDER BY customers DESC, segment""",
    "segment_profile_by_value": f"""
SELECT * EXCLUDE (total_exact), total_exact::DOUBLE AS total_monetary,
  total_exact::DOUBLE / nullif(sum(total_exact) OVER (), 0)::DOUBLE AS value_share
FROM ({_SEG}) s ORDER BY value_share DESC, segment""",
    "segment_value": f"""
SELECT segment, customers, average_recency, average_frequency, average_monetary,
  CAST(total_exact AS DOUBLE) AS total_monetary,
  CAST(total_exact AS DOUBLE) / CAST(NULLIF(SUM(total_exact) OVER (), 0) AS DOUBLE) * 100.0 AS sales_share_pct
FROM ({_SEG}) s ORDER BY total_monetary DESC, segment""",
    "segment_distribution": """
SELECT l.display_order, l.segment, c.customers,
  ROUND_EVEN(CAST(c.customers AS DOUBLE) / CAST(NULLIF(t.n, 0) AS DOUBLE) * 100 * 100, 0) / 100 AS customer_pct
FROM (VALUES (1, 'Champions'), (2, 'Loyal'), (3, 'Potential'), (4, 'Regular'), (5, 'At Risk'),
             (6, 'Low Value')) l(display_order, segment)
LEFT JOIN (SELECT segment, COUNT(*) AS customers FROM rfm GROUP BY segment) c ON c.segment = l.segment
CROSS JOIN (SELECT COUNT(*) AS n FROM rfm) t
ORDER BY l.display_order""",
    "customer_explorer": """
SELECT customer_id, recency, frequency, monetary, rfm_total_score, segment
FROM rfm ORDER BY monetary DESC, customer_id""",
    "segment_list": """
SELECT segment, position FROM (
  SELECT 'All' AS segment, 0 AS position
  UNION ALL SELECT DISTINCT segment, 1 AS position FROM rfm) s
ORDER BY position, segment""",
    "score_distribution": """
SELECT score_type, score, COUNT(*) AS customers FROM (
  SELECT 'r_score' AS score_type, r_score AS score FROM rfm
  UNION ALL SELECT 'f_score', f_score FROM rfm
  UNION ALL SELECT 'm_score', m_score FROM rfm) s
GROUP BY score_type, score ORDER BY score_type, score""",
    "rfm_stats": describe_sql("SELECT recency, frequency, monetary FROM rfm", ["recency", "frequency", "monetary"], 2),
    "check_rfm": """
SELECT COUNT(*) AS rows, COUNT(DISTINCT customer_id) AS customers,
  COUNT(*) = COUNT(DISTINCT customer_id) AS grain_valid,
  MIN(recency) AS min_recency, MAX(recency) AS max_recency,
  MIN(rfm_total_score) AS min_score, MAX(rfm_total_score) AS max_score,
  CAST(SUM(CASE WHEN monetary <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS monetary_le_0,
  CAST(SUM(CASE WHEN recency < 0 THEN 1 ELSE 0 END) AS BIGINT) AS recency_lt_0,
  CAST(SUM(CASE WHEN frequency <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS frequency_le_0,
  BOOL_AND(r_score BETWEEN 1 AND 5 AND f_score BETWEEN 1 AND 5 AND m_score BETWEEN 1 AND 5) AS scores_valid
FROM rfm""",
    "customer_frequency": _FREQ + " ORDER BY purchase_count DESC, customer_id",
    "frequency_stats": describe_sql(_FREQ, ["purchase_count"]),
    "frequency_distribution": f"""
SELECT l.band_order, l.frequency_group, c.customers
FROM (VALUES (1, '1 commande'), (2, '2 commandes'), (3, '3 à 5 commandes'), (4, '6 à 10 commandes'),
             (5, 'Plus de 10 commandes')) l(band_order, frequency_group)
LEFT JOIN (
  SELECT CASE WHEN purchase_count = 1 THEN '1 commande' WHEN purchase_count = 2 THEN '2 commandes'
              WHEN purchase_count <= 5 THEN '3 à 5 commandes' WHEN purchase_count <= 10 THEN '6 à 10 commandes'
              ELSE 'Plus de 10 commandes' END AS frequency_group, COUNT(*) AS customers
  FROM ({_FREQ}) f GROUP BY 1) c ON c.frequency_group = l.frequency_group
ORDER BY l.band_order""",
    "customer_pareto": f"""
SELECT customer_id, net_product_sales, cumulative_sales, cumulative_sales_pct, cumulative_customers_pct
FROM ({_PARETO_PCT}) x ORDER BY cumulative_customers_pct""",
    "pareto_top_shares": f"""
SELECT t.top_customers_pct,
  CAST(COALESCE(SUM(CASE WHEN p.cumulative_customers_pct <= t.top_customers_pct THEN p.net_exact END), 0) AS DOUBLE)
    / CAST(NULLIF(MAX(p.total), 0) AS DOUBLE) * 100 AS sales_share_pct
FROM (VALUES (1), (5), (10), (20)) t(top_customers_pct)
CROSS JOIN ({_PARETO_PCT}) p
GROUP BY t.top_customers_pct ORDER BY t.top_customers_pct""",
    "pareto_80": f"""
SELECT MIN(cumulative_customers_pct) AS customers_for_80_pct
FROM ({_PARETO_PCT}) p WHERE cumulative_sales_pct >= 80.0""",
    "customer_overview": """
SELECT COUNT(DISTINCT customer_id) AS identified_customers,
  CAST(SUM(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS invoices_without_customer,
  COUNT(DISTINCT CASE WHEN customer_id IS NOT NULL THEN Invoice END) AS invoices_with_customer
FROM fo""",
    "customer_preview": """
SELECT customer_id,
  MIN(order_datetime) AS first_activity_datetime, MAX(order_datetime) AS last_activity_datetime,
  COUNT(*) AS invoice_count,
  CAST(SUM(CASE WHEN has_product_sale THEN 1 ELSE 0 END) AS BIGINT) AS purchase_invoice_count,
  CAST(SUM(CASE WHEN has_product_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_invoice_count,
  COUNT(DISTINCT country) AS distinct_countries,
  CAST(ROUND(SUM(gross_product_sales_value), 2) AS DOUBLE) AS gross_product_sales_value,
  CAST(ROUND(SUM(product_cancellation_value), 2) AS DOUBLE) AS product_cancellation_value,
  CAST(ROUND(SUM(net_product_sales_value), 2) AS DOUBLE) AS net_product_sales_value
FROM fo WHERE customer_id IS NOT NULL
GROUP BY customer_id ORDER BY net_product_sales_value DESC, customer_id LIMIT 20""",
    "multi_country_customers": "SELECT * FROM dc WHERE is_multi_country = TRUE ORDER BY customer_id",
    "export_rfm": """
SELECT customer_id, last_purchase_datetime, recency, CAST(frequency AS BIGINT) AS frequency, monetary,
  r_score, f_score, m_score, rfm_code, rfm_total_score, segment, rfm_reference_date
FROM rfm ORDER BY customer_id""",
}
