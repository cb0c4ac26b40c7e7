"""SQL builders for exact quantiles / describe / histograms (oracle side).

Brute force: positions from ``ROW_NUMBER() OVER (ORDER BY x)`` over the whole
input, then the same interpolation formula as the Spark operator.
"""

from __future__ import annotations


def quantiles_sql(src: str, col: str, qs, value_name: str = "value") -> str:
    qvals = ", ".join(f"(CAST({float(q)!r} AS DOUBLE))" for q in qs)
    return f"""
SELECT q.quantile,
  CASE WHEN p.t >= 0.5 THEN p.b - (p.b - p.a) * (1.0 - p.t) ELSE p.a + (p.b - p.a) * p.t END AS {value_name}
FROM (VALUES {qvals}) q(quantile)
JOIN (
  SELECT q2.quantile,
    MAX(CASE WHEN v.pos = FLOOR(CAST(v.n - 1 AS DOUBLE) * q2.quantile) THEN v.x END) AS a,
    MAX(CASE WHEN v.pos = LEAST(FLOOR(CAST(v.n - 1 AS DOUBLE) * q2.quantile) + 1, v.n - 1) THEN v.x END) AS b,
    MAX(CAST(v.n - 1 AS DOUBLE) * q2.quantile - FLOOR(CAST(v.n - 1 AS DOUBLE) * q2.quantile)) AS t
  FROM (SELECT CAST({col} AS DOUBLE) AS x,
               ROW_NUMBER() OVER (ORDER BY CAST({col} AS DOUBLE)) - 1 AS pos,
               COUNT(*) OVER () AS n
        FROM ({src}) s WHERE {col} IS NOT NULL) v,
       (VALUES {qvals}) q2(quantile)
  GROUP BY q2.quantile) p ON p.quantile = q.quantile
"""


def describe_sql(src: str, cols: list[str], places: int = 0) -> str:
    """``places``: decimal places of the values (whole units carry the squares)."""
    parts = []
    for c in cols:
        q = quantiles_sql(src, c, (0.25, 0.5, 0.75))
        parts.append(f"""
SELECT '{c}' AS "column", m.n AS count, m.s / nullif(m.n, 0) AS mean,
  sqrt(greatest(CAST(m.spread AS DOUBLE) / CASE WHEN m.n > 1 THEN CAST(m.n AS DOUBLE) * (m.n - 1) END / 1e{2 * places}, 0.0)) AS std,
  m.low AS min,
  (SELECT value FROM ({q}) qq WHERE quantile = 0.25) AS p25,
  (SELECT value FROM ({q}) qq WHERE quantile = 0.5) AS p50,
  (SELECT value FROM ({q}) qq WHERE quantile = 0.75) AS p75,
  m.high AS max
FROM (
  SELECT count(x) AS n, CAST(sum(x) AS DOUBLE) AS s, CAST(min(x) AS DOUBLE) AS low, CAST(max(x) AS DOUBLE) AS high,
    -- through text: the cast of a wide integer to a double then rounds correctly
    CAST(CAST(count(x) AS HUGEINT) * CAST(sum(u * u) AS HUGEINT) - CAST(sum(u) AS HUGEINT) * CAST(sum(u) AS HUGEINT) AS VARCHAR) AS spread
  FROM (SELECT CAST({c} AS DECIMAL(38,{places})) AS x, CAST(CAST({c} AS DECIMAL(38,{places})) * {10 ** places} AS HUGEINT) AS u
        FROM ({src}) s) t) m""")
    return "\nUNION ALL\n".join(parts)


def histogram_sql(src: str, col: str, bins: int) -> str:
    """numpy-style equal-width bins over [min, max] of ``src``."""
    return f"""
SELECT b.bin,
  r.lo + (b.bin - 1) * ((r.hi - r.lo) / {bins}) AS bin_start,
  r.lo + b.bin * ((r.hi - r.lo) / {bins}) AS bin_end,
  CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(range + 1 AS INTEGER) AS bin FROM range({bins})) b
CROSS JOIN (SELECT MIN(CAST({col} AS DOUBLE)) AS lo, MAX(CAST({col} AS DOUBLE)) AS hi
            FROM ({src}) s WHERE {col} IS NOT NULL) r
LEFT JOIN (
  SELECT CASE WHEN r2.hi = r2.lo THEN 1
              ELSE LEAST(CAST(FLOOR((CAST(s.{col} AS DOUBLE) - r2.lo) * (CAST({bins} AS DOUBLE) / (r2.hi - r2.lo))) AS INTEGER) + 1,
                         {bins}) END AS bin,
         COUNT(*) AS cnt
  FROM ({src}) s
  CROSS JOIN (SELECT MIN(CAST({col} AS DOUBLE)) AS lo, MAX(CAST({col} AS DOUBLE)) AS hi
              FROM ({src}) s3 WHERE {col} IS NOT NULL) r2
  WHERE s.{col} IS NOT NULL
  GROUP BY 1) c ON c.bin = b.bin
"""
