"""Supplied test tables → two raw invoice-line periods.

The test data are TPC-H-like tables; this deterministic mapping turns
``lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation`` into the 8 raw line columns
so that every edge case of the retail data occurs (cancellations, negative
quantities without a ``C``, zero and negative prices, missing customers and
descriptions, special codes, exact repeats, invoices with two timestamps,
customers in two countries).  It is a plain join + projection: it scales with
the tables and keeps every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.session import task_count

# Fixed values of the mapping (shared with the DuckDB oracle).
ORDER_OFFSET = 500000
PART_OFFSET = 20000
SPECIAL_CODE_BY_PART_MOD_97 = {0: "POST", 1: "M", 2: "DCGS0003", 3: "D", 4: "m", 5: "GIFT"}
OVERLAP_START = "1998-12-01 00:00:00"   # later period starts here
OVERLAP_END = "1998-12-10 00:00:00"     # earlier period ends before this
PERIOD_EARLY = "1995-1998"
PERIOD_LATE = "1998-2001"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All mapped lines (repeats included), 8 raw columns; no period yet."""
    l = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation: 25 rows by definition of the schema → broadcast is bounded.
    n = F.broadcast(_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))

    cust = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    orders = o.join(cust, o.o_custkey == cust.c_custkey)
    # lineitem and orders are both fact-sized: a shuffle (sort-merge) join on the
    # order key, never a broadcast of either; part may broadcast if Spark's
    # size estimate allows.  The tasks also sort the wide lines for their folders, so
    # their number grows with the lines (a count that reads file footers only).
    tasks = task_count(spark, l.count())
    joined = (l.repartition(tasks, "l_orderkey")
               .join(orders.repartition(tasks, "o_orderkey").hint("merge"), l.l_orderkey == orders.o_orderkey)
               .join(p, l.l_partkey == p.p_partkey))

    z = ((F.col("l_orderkey") + F.col("l_linenumber")) % 83) == 0
    returned = F.col("l_returnflag") == "R"
    keep_sign = ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 997) == 1
    neg_price = ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 9973) == 0
    qty = F.col("l_quantity").cast("bigint")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    adjusted = ((key * 3 + line) % 4001 == 0) & ~returned       # invoices with the A prefix
    dear = (key * 11 + line) % 1009 == 0                        # prices above 1000 and 10000
    negative = (key * 13 + line) % 499 == 0                     # negative without C, described
    half_known = (F.col("o_orderkey") % 307 == 0) & (line % 2 == 1)  # customer on some lines only

    mod97 = F.col("p_partkey") % 97
    code: Column = F.when(mod97 == 0, SPECIAL_CODE_BY_PART_MOD_97[0])
    for k in range(1, len(SPECIAL_CODE_BY_PART_MOD_97)):
        code = code.when(mod97 == k, SPECIAL_CODE_BY_PART_MOD_97[k])
    code = code.otherwise((F.col("p_partkey") + PART_OFFSET).cast("string"))

    minutes = (F.col("o_orderkey") % 1440) + F.when(
        (F.col("o_orderkey") % 53) == 0, F.col("l_linenumber") % 2).otherwise(0)
    ts = F.timestamp_add("MINUTE", minutes, F.col("o_orderdate").cast("timestamp_ntz"))

    sign = F.when(z, 0).when(neg_price, -1).otherwise(1).cast("decimal(1,0)")
    price = (sign * F.when(dear, 12).otherwise(1).cast("decimal(2,0)")
             * F.col("p_retailprice").cast("decimal(12,2)")).cast("decimal(12,2)")

    places = key + line + F.col("l_suppkey")
    copies = F.sequence(F.lit(1), F.when(places % 1013 == 0, 3).when(places % 101 == 0, 2).otherwise(1))

    return joined.select(
        F.concat(F.when(returned, "C").when(adjusted, "A").otherwise(""),
                 (F.col("l_orderkey") + ORDER_OFFSET).cast("string")).alias(S.INVOICE),
        code.alias(S.STOCK_CODE),
        F.when(z, F.lit(None).cast("string"))
         .when((F.col("l_orderkey") % 5) == 0, F.concat_ws(" ", "p_name", "p_brand"))
         .otherwise(F.col("p_name")).alias(S.DESCRIPTION),
        F.when(keep_sign, qty).when(returned | z | negative, -qty).otherwise(qty).alias(S.QUANTITY),
        ts.alias(S.INVOICE_DATE),
        price.alias(S.PRICE),
        F.when((((F.col("o_custkey") % 5) == 0) & ((F.col("o_orderkey") % 2) == 0)) | half_known,
               F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias(S.CUSTOMER),
        F.when((F.col("o_orderkey") % 211) == 0, F.lit("EIRE"))
         .otherwise(F.col("n_name")).alias(S.COUNTRY),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


RAW_PERIOD_COL = "raw_period"


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both raw periods in one pass over the join, tagged by ``raw_period``
    (lines of the shared days belong to both).  Written partitioned by
    ``raw_period``, each partition folder is one period file."""
    ts = F.col(S.INVOICE_DATE)
    in_early = ts < F.lit(OVERLAP_END).cast("timestamp_ntz")
    in_late = ts >= F.lit(OVERLAP_START).cast("timestamp_ntz")
    periods = F.filter(F.array(F.when(in_early, F.lit(PERIOD_EARLY)), F.when(in_late, F.lit(PERIOD_LATE))),
                       lambda x: x.isNotNull())
    return mapped_lines(spark, sf_dir).withColumn(RAW_PERIOD_COL, F.explode(periods))


# ---------------------------------------------------------------------------
# The same mapping in DuckDB SQL, for the oracle.  Produces the consolidated
# bronze lines (period cut + provenance literal applied).
# ---------------------------------------------------------------------------

def _code_sql() -> str:
    arms = " ".join(f"WHEN p.p_partkey % 97 = {k} THEN '{v}'"
                    for k, v in SPECIAL_CODE_BY_PART_MOD_97.items())
    return f"CASE {arms} ELSE CAST(p.p_partkey + {PART_OFFSET} AS VARCHAR) END"


MAPPED_LINES_SQL = f"""
SELECT
  (CASE WHEN l.l_returnflag = 'R' THEN 'C'
        WHEN (l.l_orderkey * 3 + l.l_linenumber) % 4001 = 0 THEN 'A' ELSE '' END)
    || CAST(l.l_orderkey + {ORDER_OFFSET} AS VARCHAR) AS Invoice,
  {_code_sql()} AS StockCode,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 83 = 0 THEN NULL
       WHEN l.l_orderkey % 5 = 0 THEN p.p_name || ' ' || p.p_brand
       ELSE p.p_name END AS Description,
  CASE WHEN (l.l_orderkey * 7 + l.l_partkey) % 997 = 1 THEN CAST(l.l_quantity AS BIGINT)
       WHEN l.l_returnflag = 'R' OR (l.l_orderkey + l.l_linenumber) % 83 = 0
         OR (l.l_orderkey * 13 + l.l_linenumber) % 499 = 0
         THEN -CAST(l.l_quantity AS BIGINT)
       ELSE CAST(l.l_quantity AS BIGINT) END AS Quantity,
  CAST(o.o_orderdate AS TIMESTAMP)
    + to_minutes(CAST(o.o_orderkey % 1440
        + CASE WHEN o.o_orderkey % 53 = 0 THEN l.l_linenumber % 2 ELSE 0 END AS BIGINT))
    AS InvoiceDate,
  CAST(CAST(CASE WHEN (l.l_orderkey + l.l_linenumber) % 83 = 0 THEN 0
                 WHEN (l.l_orderkey * 7 + l.l_partkey) % 9973 = 0 THEN -1
                 ELSE 1 END AS DECIMAL(1,0))
       * CAST(CASE WHEN (l.l_orderkey * 11 + l.l_linenumber) % 1009 = 0 THEN 12 ELSE 1 END AS DECIMAL(2,0))
       * CAST(p.p_retailprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS Price,
  CASE WHEN (o.o_custkey % 5 = 0 AND o.o_orderkey % 2 = 0)
         OR (o.o_orderkey % 307 = 0 AND l.l_linenumber % 2 = 1) THEN NULL
       ELSE o.o_custkey END AS customer_id_raw,
  CASE WHEN o.o_orderkey % 211 = 0 THEN 'EIRE' ELSE n.n_name END AS Country,
  CASE WHEN (l.l_orderkey + l.l_linenumber + l.l_suppkey) % 1013 = 0 THEN 3
       WHEN (l.l_orderkey + l.l_linenumber + l.l_suppkey) % 101 = 0 THEN 2 ELSE 1 END AS copies
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

# Every mapped line as often as it is repeated.
REPEATED_LINES_SQL = "SELECT m.* FROM mapped_src m, range(m.copies) r"

# Raw period A keeps its own literal on the overlap rows; the consolidation
# keeps A before the cut and all of B.
BRONZE_SQL = f"""
SELECT Invoice, StockCode, Description, Quantity, InvoiceDate,
       CAST(Price AS DECIMAL(18,4)) AS Price, customer_id_raw, Country,
       CASE WHEN InvoiceDate < TIMESTAMP '{OVERLAP_START}' THEN '{PERIOD_EARLY}'
            ELSE '{PERIOD_LATE}' END AS SourcePeriod
FROM ({REPEATED_LINES_SQL}) m
"""
