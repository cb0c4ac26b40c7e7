"""DuckDB oracle SQL for ``plans.audit``."""

from tillroll.oracle.stats import describe_sql, quantiles_sql
from tillroll.plans.audit import HIGH_PRICE, PRICE_QUANTILES, PRICE_SERIES_DESCRIPTION
from tillroll.sources import fixture_map as FM

_BUS = ("Invoice, StockCode, Description, Quantity, InvoiceDate, CAST(Price AS DOUBLE) AS Price, "
        "customer_id_raw, Country")
_C = "COALESCE(Invoice LIKE 'C%', FALSE)"


def _cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _top(src: str, col: str, n: int, group: str | None = None) -> str:
    if group is None:
        return f"""
SELECT {col}, rows, ROW_NUMBER() OVER (ORDER BY rows DESC, {col} ASC NULLS LAST) AS rank FROM (
  SELECT {col}, COUNT(*) AS rows FROM ({src}) s GROUP BY {col}
  ORDER BY rows DESC, {col} ASC NULLS LAST LIMIT {n}) t"""
    return f"""
SELECT * FROM (
  SELECT {group}, {col}, rows,
    ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY rows DESC, {col} ASC NULLS LAST) AS rank
  FROM (SELECT {group}, {col}, COUNT(*) AS rows FROM ({src}) s GROUP BY {group}, {col}) t) u
WHERE rank <= {n}"""


_OVERLAP = f"InvoiceDate >= TIMESTAMP '{FM.OVERLAP_START}' AND InvoiceDate < TIMESTAMP '{FM.OVERLAP_END}'"
_SPECIAL = "SELECT * FROM bronze WHERE NOT COALESCE(regexp_matches(StockCode, '^[0-9]'), FALSE)"
_SPECIAL_NN = _SPECIAL + " AND StockCode IS NOT NULL"
_CLASSIFIED = f"""
SELECT c.StockCode AS stock_code, COALESCE(r.rule_category, 'unknown') AS rule_category
FROM (SELECT DISTINCT StockCode FROM ({_SPECIAL_NN}) s) c
LEFT JOIN audit_rules r ON c.StockCode = r.rule_code"""
_GROUPS9 = ("SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, customer_id_raw, Country, "
            "SourcePeriod, COUNT(*) AS n FROM bronze GROUP BY ALL")
_MIXED = f"""
SELECT Invoice, {_cnt('customer_id_raw IS NULL')} AS rows_without_customer,
  {_cnt('customer_id_raw IS NOT NULL')} AS rows_with_customer
FROM bronze WHERE Invoice IS NOT NULL GROUP BY Invoice
HAVING SUM(CASE WHEN customer_id_raw IS NULL THEN 1 ELSE 0 END) > 0
   AND SUM(CASE WHEN customer_id_raw IS NOT NULL THEN 1 ELSE 0 END) > 0"""
_DESC_PER_CODE = "SELECT StockCode, COUNT(DISTINCT Description) AS descriptions FROM bronze GROUP BY StockCode"
_PRICE_SERIES = (f"SELECT * FROM bronze WHERE COALESCE(regexp_replace(Description, '^\\s+|\\s+$', '', 'g') "
                 f"= '{PRICE_SERIES_DESCRIPTION}', FALSE)")


_GAP_SECONDS = """
SELECT date_diff('second', first_date, last_date) AS gap_seconds FROM (
  SELECT Invoice, COUNT(DISTINCT InvoiceDate) AS dates, MIN(InvoiceDate) AS first_date,
    MAX(InvoiceDate) AS last_date
  FROM bronze WHERE Invoice IS NOT NULL GROUP BY Invoice) g
WHERE dates > 1"""


def _nulls(t: str) -> str:
    cols = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "customer_id_raw", "Country"]
    nulls = ", ".join(f"{_cnt(c + ' IS NULL')} AS null_{c}" for c in cols)
    return (f"SELECT SourcePeriod, COUNT(*) AS rows, {nulls}, MIN(InvoiceDate) AS first_date, "
            f"MAX(InvoiceDate) AS last_date FROM {t} GROUP BY SourcePeriod")


SQL = {
    "audit_nulls": _nulls("raw_a") + " UNION ALL " + _nulls("raw_b"),
    "audit_overlap": f"""
WITH a AS (SELECT {_BUS} FROM raw_a WHERE {_OVERLAP}),
b AS (SELECT {_BUS} FROM raw_b WHERE {_OVERLAP})
SELECT x.rows_a, x.invoices_a, y.rows_b, y.invoices_b, z.common_invoices, ea.only_in_a, eb.only_in_b,
  x.rows_a = y.rows_b AS same_row_count, (ea.only_in_a = 0 AND eb.only_in_b = 0) AS identical_rows
FROM (SELECT COUNT(*) AS rows_a, COUNT(DISTINCT Invoice) AS invoices_a FROM a) x
CROSS JOIN (SELECT COUNT(*) AS rows_b, COUNT(DISTINCT Invoice) AS invoices_b FROM b) y
CROSS JOIN (SELECT COUNT(*) AS common_invoices FROM (
  SELECT Invoice FROM a WHERE Invoice IS NOT NULL INTERSECT SELECT Invoice FROM b WHERE Invoice IS NOT NULL) i) z
CROSS JOIN (SELECT COUNT(*) AS only_in_a FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) d) ea
CROSS JOIN (SELECT COUNT(*) AS only_in_b FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) d) eb""",
    "audit_common_invoices": f"""
SELECT Invoice FROM raw_a WHERE {_OVERLAP} AND Invoice IS NOT NULL
INTERSECT
SELECT Invoice FROM raw_b WHERE {_OVERLAP} AND Invoice IS NOT NULL
ORDER BY Invoice""",
    "audit_quantity_signs": f"""
SELECT {_cnt('Quantity < 0')} AS negative_rows,
  COUNT(DISTINCT CASE WHEN Quantity < 0 THEN Invoice END) AS negative_invoices,
  {_cnt('Quantity < 0 AND ' + _C)} AS negative_on_c_rows,
  CAST({_cnt('Quantity < 0 AND ' + _C)} AS DOUBLE) / CAST(NULLIF({_cnt('Quantity < 0')}, 0) AS DOUBLE) * 100
    AS negative_on_c_pct,
  {_cnt('Quantity < 0 AND NOT ' + _C)} AS negative_without_c_rows,
  CAST({_cnt('Quantity < 0 AND NOT ' + _C)} AS DOUBLE) / CAST(NULLIF({_cnt('Quantity < 0')}, 0) AS DOUBLE) * 100
    AS negative_without_c_pct,
  {_cnt(_C)} AS c_rows,
  {_cnt(_C + ' AND Quantity < 0')} AS c_negative_quantity,
  {_cnt(_C + ' AND Quantity = 0')} AS c_zero_quantity,
  {_cnt(_C + ' AND Quantity > 0')} AS c_positive_quantity
FROM bronze""",
    "audit_positive_cancellations": f"""
SELECT * REPLACE (CAST(Price AS DOUBLE) AS Price) FROM bronze WHERE {_C} AND Quantity > 0
ORDER BY Invoice, StockCode, InvoiceDate""",
    "audit_top_descriptions": _top(f"SELECT * FROM bronze WHERE Quantity < 0 AND NOT {_C}", "Description", 20),
    "audit_price_classes": f"""
SELECT {_cnt('Price < 0')} AS negative_price, {_cnt('Price = 0')} AS zero_price,
  {_cnt('Price > 0')} AS positive_price, {_cnt('Price > 200')} AS price_gt_200,
  {_cnt('Price > 1000')} AS price_gt_1000, {_cnt('Price > 10000')} AS price_gt_10000
FROM bronze""",
    "audit_negative_price": """
SELECT Invoice, StockCode, Description, Quantity, CAST(Price AS DOUBLE) AS Price, customer_id_raw, Country
FROM bronze WHERE Price < 0 ORDER BY Invoice, StockCode""",
    "price_quantiles": quantiles_sql("SELECT Price FROM bronze WHERE Price > 0", "Price", PRICE_QUANTILES)
    + " ORDER BY quantile",
    "price_quantiles_approx": f"""
WITH p AS (SELECT Price::DOUBLE AS p, (Price * 10000)::BIGINT AS u FROM bronze WHERE Price > 0),
digits AS (SELECT u, greatest(length(bin(u)) - 8, 0) AS dropped FROM p),
cells AS (SELECT (u >> dropped) << dropped AS low, 1::BIGINT << dropped AS width, count(*) AS n FROM digits GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (ORDER BY low) - n AS before, sum(n) OVER () AS al FROM cells),
asked AS (SELECT *, floor((al - 1)::DOUBLE * quantile) AS place FROM ranked, (SELECT unnest({list(PRICE_QUANTILES)})::DOUBLE AS quantile)),
guess AS (
  SELECT quantile, (low + floor((width - 1) * ((place - before + 0.5) / n))) / 10000 AS value, low / 10000 AS low,
    (low + width - 1) / 10000 AS high, n / al AS rank_bound
  FROM asked WHERE before <= place AND place < before + n),
ranks AS (
  SELECT g.quantile, count(*) AS al, count(*) FILTER (p < value) AS below, count(*) FILTER (p <= value) AS upto FROM p, guess g GROUP BY ALL),
errors AS (
  SELECT quantile, greatest(below - place, place - greatest(upto - 1, below), 0)::DOUBLE / al AS rank_error
  FROM (SELECT *, floor((al - 1)::DOUBLE * quantile) AS place FROM ranks))
SELECT g.quantile, g.value, g.low, g.high, e.value AS exact_value, rank_error, rank_bound, rank_error <= rank_bound AS within_bound
FROM guess g JOIN errors USING (quantile) JOIN ({quantiles_sql("SELECT Price FROM bronze WHERE Price > 0", "Price", PRICE_QUANTILES)}) e USING (quantile)
ORDER BY quantile""",
    "audit_high_price_values": f"""
SELECT 'Description' AS field, Description AS value, rows, rank FROM (
  {_top(f'SELECT * FROM bronze WHERE Price > {HIGH_PRICE}', 'Description', 20)}) d
UNION ALL
SELECT 'StockCode' AS field, StockCode AS value, rows, rank FROM (
  {_top(f'SELECT * FROM bronze WHERE Price > {HIGH_PRICE}', 'StockCode', 20)}) s""",
    "flag_price_stats": describe_sql(_PRICE_SERIES, ["Price"], 4),
    "flag_price_counts": f"""
SELECT CAST(Price AS DOUBLE) AS price, COUNT(*) AS rows FROM ({_PRICE_SERIES}) s GROUP BY 1 ORDER BY 1""",
    "audit_missing_customer": f"""
SELECT {_cnt('customer_id_raw IS NULL')} AS missing_customer_rows, COUNT(*) AS total_rows,
  CAST({_cnt('customer_id_raw IS NULL')} AS DOUBLE) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) * 100
    AS missing_customer_pct,
  COUNT(DISTINCT CASE WHEN customer_id_raw IS NULL THEN Invoice END) AS invoices,
  COUNT(DISTINCT CASE WHEN customer_id_raw IS NULL THEN Country END) AS countries,
  {_cnt('customer_id_raw IS NULL AND Quantity > 0 AND Price > 0')} AS positive_quantity_price_rows,
  (SELECT COUNT(*) FROM ({_MIXED}) m) AS mixed_invoices
FROM bronze""",
    "audit_mixed_invoices": _MIXED + " ORDER BY Invoice",
    "audit_missing_customer_by_country": f"""
SELECT Country, missing_customer_rows, total_rows,
  CAST(missing_customer_rows AS DOUBLE) / CAST(NULLIF(total_rows, 0) AS DOUBLE) * 100 AS missing_rate_pct
FROM (SELECT Country, {_cnt('customer_id_raw IS NULL')} AS missing_customer_rows, COUNT(*) AS total_rows
      FROM bronze WHERE Country IS NOT NULL GROUP BY Country) c
WHERE missing_customer_rows > 0 ORDER BY missing_customer_rows DESC, Country""",
    "audit_missing_description": f"""
SELECT {_cnt('Description IS NULL')} AS missing_description_rows,
  CAST({_cnt('Description IS NULL')} AS DOUBLE) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE) * 100
    AS missing_description_pct,
  {_cnt('Description IS NULL AND Quantity < 0')} AS negative_quantity,
  {_cnt('Description IS NULL AND Quantity > 0')} AS positive_quantity,
  {_cnt('Description IS NULL AND Price = 0')} AS zero_price,
  {_cnt('Description IS NULL AND Price > 0')} AS positive_price,
  {_cnt('Description IS NULL AND customer_id_raw IS NULL')} AS missing_customer
FROM bronze""",
    "audit_missing_description_codes": _top("SELECT * FROM bronze WHERE Description IS NULL", "StockCode", 30),
    "audit_duplicates": f"""
SELECT *, CAST(surplus_rows AS DOUBLE) / CAST(NULLIF(total_rows, 0) AS DOUBLE) * 100 AS surplus_pct FROM (
  SELECT CAST(SUM(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS surplus_rows,
    CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_groups,
    COUNT(DISTINCT CASE WHEN n > 1 THEN Invoice END) AS invoices,
    CAST(SUM(n) AS BIGINT) AS total_rows
  FROM ({_GROUPS9}) g) t""",
    "audit_duplicate_sizes": """
SELECT n AS group_size, COUNT(*) AS groups FROM (
  SELECT COUNT(*) AS n FROM bronze
  GROUP BY Invoice, StockCode, Description, Quantity, InvoiceDate, Price, customer_id_raw, Country) g
WHERE n > 1 GROUP BY n ORDER BY n""",
    "audit_duplicate_rows": f"""
SELECT {_BUS} FROM silver WHERE is_repeated_row
ORDER BY Invoice NULLS FIRST, StockCode NULLS FIRST, InvoiceDate NULLS FIRST, Description NULLS FIRST,
  Quantity NULLS FIRST, Price NULLS FIRST, customer_id_raw NULLS FIRST, Country NULLS FIRST LIMIT 30""",
    "audit_dedup_impact": f"""
SELECT rows_before, rows_after, rows_before - rows_after AS rows_removed,
  CAST(rows_before - rows_after AS DOUBLE) / CAST(NULLIF(rows_before, 0) AS DOUBLE) * 100 AS reduction_pct,
  CAST(v_all AS DOUBLE) AS value_all, CAST(v_dedup AS DOUBLE) AS value_deduplicated,
  CAST(v_all - v_dedup AS DOUBLE) AS difference,
  CAST(v_all - v_dedup AS DOUBLE) / CAST(NULLIF(v_all, 0) AS DOUBLE) * 100 AS relative_difference_pct
FROM (SELECT CAST(SUM(n) AS BIGINT) AS rows_before, COUNT(*) AS rows_after,
        SUM(CAST(Quantity AS DECIMAL(20,0)) * Price * n) AS v_all,
        SUM(CAST(Quantity AS DECIMAL(20,0)) * Price) AS v_dedup
      FROM ({_GROUPS9}) g) t""",
    "audit_invoice_prefix": """
SELECT COALESCE(NULLIF(regexp_extract(Invoice, '^([A-Za-z]+)', 1), ''), 'NUMERIC') AS prefix, COUNT(*) AS rows
FROM bronze GROUP BY 1 ORDER BY rows DESC, prefix""",
    "audit_a_invoices": f"""
SELECT {_BUS} FROM bronze WHERE COALESCE(Invoice LIKE 'A%', FALSE) ORDER BY InvoiceDate, Invoice, StockCode""",
    "audit_special_codes": f"""
SELECT i.*, m.Description, m.description_rows FROM (
  SELECT StockCode, COUNT(*) AS rows, COUNT(DISTINCT Description) AS descriptions,
    {_cnt(_C)} AS cancellations, {_cnt('Quantity < 0')} AS negative_quantity,
    {_cnt('Price = 0')} AS zero_price, CAST(MIN(Price) AS DOUBLE) AS min_price,
    CAST(MAX(Price) AS DOUBLE) AS max_price, CAST(SUM(Quantity) AS BIGINT) AS total_quantity
  FROM ({_SPECIAL_NN}) s GROUP BY StockCode) i
LEFT JOIN (
  SELECT StockCode, Description, description_rows FROM (
    SELECT StockCode, Description, COUNT(*) AS description_rows,
      ROW_NUMBER() OVER (PARTITION BY StockCode ORDER BY COUNT(*) DESC, Description ASC NULLS LAST) AS r
    FROM ({_SPECIAL_NN}) s GROUP BY StockCode, Description) x WHERE r = 1) m
ON i.StockCode = m.StockCode
ORDER BY rows DESC, StockCode""",
    "audit_special_code_descriptions": _top(_SPECIAL_NN, "Description", 10, group="StockCode"),
    "audit_classification": f"""
SELECT stock_code, CASE WHEN rule_category = 'unknown' THEN 'stock_movement' ELSE rule_category END AS category
FROM ({_CLASSIFIED}) c ORDER BY stock_code""",
    "audit_category_counts": f"""
SELECT COALESCE(b.category, a.category) AS category, b.codes_by_rules, a.codes_final FROM
  (SELECT rule_category AS category, COUNT(*) AS codes_by_rules FROM ({_CLASSIFIED}) c GROUP BY 1) b
FULL OUTER JOIN
  (SELECT CASE WHEN rule_category = 'unknown' THEN 'stock_movement' ELSE rule_category END AS category,
     COUNT(*) AS codes_final FROM ({_CLASSIFIED}) c GROUP BY 1) a
ON a.category = b.category ORDER BY category""",
    "audit_unclassified_codes": f"""
SELECT {_BUS} FROM bronze
WHERE StockCode IN (SELECT stock_code FROM ({_CLASSIFIED}) c WHERE rule_category = 'unknown')
ORDER BY StockCode, Invoice, InvoiceDate""",
    "audit_invoice_grain": f"""
SELECT MAX(dates) AS max_dates, MAX(customers) AS max_customers, MAX(countries) AS max_countries,
  {_cnt('dates > 1')} AS invoices_multi_dates, {_cnt('customers > 1')} AS invoices_multi_customers,
  {_cnt('countries > 1')} AS invoices_multi_countries
FROM (SELECT Invoice, COUNT(DISTINCT InvoiceDate) AS dates, COUNT(DISTINCT customer_id_raw) AS customers,
        COUNT(DISTINCT Country) AS countries FROM bronze GROUP BY Invoice) g""",
    "audit_multi_timestamp": """
SELECT Invoice, first_date, last_date, rows,
  CAST(date_diff('second', first_date, last_date) AS DOUBLE) / 60.0 AS gap_minutes,
  CAST(first_date AS DATE) = CAST(last_date AS DATE) AS same_day
FROM (SELECT Invoice, COUNT(DISTINCT InvoiceDate) AS dates, MIN(InvoiceDate) AS first_date,
        MAX(InvoiceDate) AS last_date, COUNT(*) AS rows
      FROM bronze WHERE Invoice IS NOT NULL GROUP BY Invoice) g
WHERE dates > 1 ORDER BY gap_minutes DESC, Invoice""",
    "audit_gap_stats": f"""
SELECT 'gap_minutes' AS "column", count, mean / 60.0 AS mean, std / 60.0 AS std, min / 60.0 AS min,
  p25 / 60.0 AS p25, p50 / 60.0 AS p50, p75 / 60.0 AS p75, max / 60.0 AS max
FROM ({describe_sql(_GAP_SECONDS, ["gap_seconds"])}) d""",
    "audit_multi_country": """
SELECT customer_id_raw, COUNT(DISTINCT Country) AS countries FROM bronze
WHERE customer_id_raw IS NOT NULL GROUP BY customer_id_raw HAVING COUNT(DISTINCT Country) > 1
ORDER BY countries DESC, customer_id_raw""",
    "audit_descriptions_per_code": _DESC_PER_CODE + " ORDER BY descriptions DESC, StockCode NULLS LAST",
    "audit_multi_description_examples": _top(
        f"""SELECT * FROM bronze WHERE StockCode IN (
              SELECT StockCode FROM ({_DESC_PER_CODE}) d WHERE descriptions > 1
              ORDER BY descriptions DESC, StockCode NULLS LAST LIMIT 5)""", "Description", 15, group="StockCode"),
    "audit_extreme_quantity": f"""
SELECT {_BUS} FROM bronze WHERE ABS(Quantity) = (SELECT MAX(ABS(Quantity)) FROM bronze)
ORDER BY InvoiceDate, Invoice""",
}
