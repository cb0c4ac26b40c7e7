"""DuckDB re-statement of the warehouse layers, as named CTEs.

Each oracle query is self-contained: it sees only the raw test tables, so it
is prefixed with the CTEs it (transitively) references.  The layers are the
plain single-node formulation (window over the full partition key, window
ranks over the whole customer set), independent of the Spark operators.
"""

from __future__ import annotations

import re

from tillroll.sources import fixture_map as FM
from tillroll.sources.reference import STOCKCODE_CATEGORIES, audit_rule_map


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(cols)})"


CTES: dict[str, str] = {}

CTES["mapped_src"] = FM.MAPPED_LINES_SQL

CTES["bronze"] = FM.BRONZE_SQL

# raw periods before the cut, typed (overlap included)
CTES["raw_a"] = f"""
SELECT Invoice, StockCode, Description, Quantity, InvoiceDate,
       CAST(Price AS DECIMAL(18,4)) AS Price, customer_id_raw, Country,
       '{FM.PERIOD_EARLY}' AS SourcePeriod
FROM ({FM.REPEATED_LINES_SQL}) m
WHERE InvoiceDate < TIMESTAMP '{FM.OVERLAP_END}'
"""

CTES["raw_b"] = f"""
SELECT Invoice, StockCode, Description, Quantity, InvoiceDate,
       CAST(Price AS DECIMAL(18,4)) AS Price, customer_id_raw, Country,
       '{FM.PERIOD_LATE}' AS SourcePeriod
FROM ({FM.REPEATED_LINES_SQL}) m
WHERE InvoiceDate >= TIMESTAMP '{FM.OVERLAP_START}'
"""

CTES["categories"] = _values(STOCKCODE_CATEGORIES, ["stock_code", "category"])

CTES["audit_rules"] = _values(audit_rule_map(), ["rule_code", "rule_category"])

# lines with their flags; a repeat is a line whose nine columns, compared with nulls
# equal, occur in a group of more than one
CTES["silver"] = """
WITH counted AS (SELECT *, count(*) AS copies_found FROM bronze GROUP BY ALL)
SELECT b.* EXCLUDE (copies_found), starts_with(b.Invoice, 'C') IS TRUE AS is_cancellation,
  (b.Quantity < 0) IS TRUE AS is_negative_quantity, (b.Price = 0) IS TRUE AS is_zero_price,
  (b.Price < 0) IS TRUE AS is_negative_price, b.customer_id_raw IS NULL AS is_missing_customer,
  b.Description IS NULL AS is_missing_description,
  b.StockCode IN (SELECT stock_code FROM categories) IS TRUE AS is_special_stockcode,
  copies_found > 1 AS is_repeated_row,
  coalesce((SELECT category FROM categories c WHERE c.stock_code = b.StockCode), 'product') AS line_category,
  b.Price * b.Quantity::DECIMAL(20,0) AS raw_line_value
FROM (SELECT * EXCLUDE (i) FROM counted, range(copies_found) r(i)) b
"""

# sale: a product bought at a price; cancellation: the same taken back on a C invoice
CTES["fol"] = """
SELECT l.* EXCLUDE (priced, bought, returned), bought AS is_product_sale, returned AS is_product_cancellation,
  (raw_line_value * bought::INT)::DECIMAL(38,4) AS gross_product_sales_value,
  (raw_line_value * returned::INT)::DECIMAL(38,4) AS product_cancellation_value,
  (raw_line_value * (bought OR returned)::INT)::DECIMAL(38,4) AS net_product_sales_value
FROM (
  SELECT *, (priced AND NOT is_cancellation AND Quantity > 0) IS TRUE AS bought,
    (priced AND is_cancellation AND is_negative_quantity) IS TRUE AS returned
  FROM (SELECT *, line_category = 'product' AND Price > 0 AS priced FROM silver)) l
"""

CTES["fo"] = """
WITH per_invoice AS (
  SELECT Invoice, count(*) AS line_count, count(DISTINCT StockCode) AS distinct_stockcodes,
    min(InvoiceDate) AS order_datetime, max(InvoiceDate) AS last_line_datetime,
    min(SourcePeriod) AS source_period, max(Country) AS country, max(customer_id_raw) AS customer_id,
    sum(Quantity)::BIGINT AS total_quantity, sum(raw_line_value) AS raw_order_value,
    sum(net_product_sales_value) AS net_product_sales_value,
    count(*) FILTER (is_cancellation) AS cancelled, count(*) FILTER (is_product_sale) AS sold,
    count(*) FILTER (is_product_cancellation) AS taken_back
  FROM fol GROUP BY Invoice),
sales AS (
  SELECT Invoice, sum(Quantity)::BIGINT AS q, sum(raw_line_value)::DECIMAL(38,4) AS v FROM fol WHERE is_product_sale GROUP BY Invoice),
returns AS (
  SELECT Invoice, sum(Quantity)::BIGINT AS q, sum(raw_line_value)::DECIMAL(38,4) AS v FROM fol WHERE is_product_cancellation GROUP BY Invoice)
SELECT i.* EXCLUDE (cancelled, sold, taken_back), cancelled > 0 AS is_cancellation, sold > 0 AS has_product_sale,
  taken_back > 0 AS has_product_cancellation,
  coalesce(s.q, 0) AS product_sale_quantity, coalesce(r.q, 0) AS product_cancellation_quantity,
  coalesce(s.v, 0)::DECIMAL(38,4) AS gross_product_sales_value, coalesce(r.v, 0)::DECIMAL(38,4) AS product_cancellation_value
FROM per_invoice i LEFT JOIN sales s ON s.Invoice IS NOT DISTINCT FROM i.Invoice
LEFT JOIN returns r ON r.Invoice IS NOT DISTINCT FROM i.Invoice
"""

CTES["dc"] = """
WITH known AS (SELECT * FROM fo WHERE customer_id IS NOT NULL),
last_seen AS (
  SELECT customer_id, country FROM known WHERE country IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_datetime DESC, country DESC) = 1)
SELECT k.customer_id, min(order_datetime) AS first_activity_datetime, max(order_datetime) AS last_activity_datetime,
  count(*) AS invoice_count, count(DISTINCT k.country) AS distinct_countries,
  count(DISTINCT k.country) > 1 AS is_multi_country, any_value(s.country) AS latest_country
FROM known k LEFT JOIN last_seen s USING (customer_id) GROUP BY k.customer_id
"""

CTES["dp"] = """
WITH last_text AS (
  SELECT StockCode, Description FROM fol WHERE Description IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY StockCode ORDER BY InvoiceDate DESC, Description DESC) = 1)
SELECT f.StockCode AS stock_code, any_value(t.Description) AS product_description, any_value(line_category) AS line_category,
  min(InvoiceDate) AS first_seen_datetime, max(InvoiceDate) AS last_seen_datetime,
  count(DISTINCT f.Description) AS distinct_descriptions
FROM fol f LEFT JOIN last_text t ON t.StockCode IS NOT DISTINCT FROM f.StockCode GROUP BY f.StockCode
"""

CTES["rfm_base"] = """
WITH value AS (
  SELECT customer_id, round(sum(net_product_sales_value), 2) AS monetary_exact FROM fo
  WHERE customer_id IS NOT NULL GROUP BY customer_id),
bought AS (
  SELECT customer_id, max(order_datetime) AS last_purchase_datetime, count(*) AS frequency FROM fo
  WHERE customer_id IS NOT NULL AND has_product_sale GROUP BY customer_id),
today AS (SELECT max(order_datetime)::DATE + 1 AS rfm_reference_date FROM fo WHERE has_product_sale)
SELECT *, (rfm_reference_date - last_purchase_datetime::DATE)::BIGINT AS recency
FROM bought JOIN value USING (customer_id), today
"""

CTES["rfm_ranked"] = """
SELECT *,
  COUNT(*) OVER () AS n_all,
  RANK() OVER (ORDER BY recency) AS r_lo,
  RANK() OVER (ORDER BY recency) + COUNT(*) OVER (PARTITION BY recency) - 1 AS r_hi,
  RANK() OVER (ORDER BY monetary_exact) AS m_lo,
  RANK() OVER (ORDER BY monetary_exact) + COUNT(*) OVER (PARTITION BY monetary_exact) - 1 AS m_hi
FROM rfm_base
"""

CTES["rfm_scored"] = """
SELECT *,
  CAST(6 - (5 * (r_lo + r_hi) + 2 * n_all - 1) // (2 * n_all) AS INTEGER) AS r_score,
  CAST(CASE WHEN frequency = 1 THEN 1 WHEN frequency = 2 THEN 2 WHEN frequency <= 5 THEN 3
            WHEN frequency <= 10 THEN 4 ELSE 5 END AS INTEGER) AS f_score,
  CAST((5 * (m_lo + m_hi) + 2 * n_all - 1) // (2 * n_all) AS INTEGER) AS m_score
FROM rfm_ranked
"""

CTES["rfm"] = """
SELECT customer_id, last_purchase_datetime, recency, frequency,
  CAST(monetary_exact AS DOUBLE) AS monetary,
  r_score, f_score, m_score,
  CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_code,
  CAST(r_score + f_score + m_score AS INTEGER) AS rfm_total_score,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
       WHEN f_score >= 4 AND m_score >= 3 THEN 'Loyal'
       WHEN r_score >= 4 AND f_score <= 3 THEN 'Potential'
       WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN 'At Risk'
       WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Low Value'
       ELSE 'Regular' END AS segment,
  rfm_reference_date
FROM rfm_scored
"""

# dependency order = insertion order of CTES
_ORDER = list(CTES)
_NAME_RE = {name: re.compile(r"\b" + re.escape(name) + r"\b") for name in _ORDER}


def _refs(sql: str) -> set[str]:
    return {n for n, rx in _NAME_RE.items() if rx.search(sql)}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every CTE it needs, transitively, in order.

    ``extra`` adds query-local CTEs (placed after the shared ones)."""
    extra = extra or {}
    needed: set[str] = set()
    todo = set(_refs(body))
    for sql in extra.values():
        todo |= _refs(sql)
    while todo:
        name = todo.pop()
        if name in needed:
            continue
        needed.add(name)
        todo |= _refs(CTES[name]) - needed
    parts = [f"{n} AS ({CTES[n]})" for n in _ORDER if n in needed]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # the body has its own CTEs: continue the same WITH list
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
