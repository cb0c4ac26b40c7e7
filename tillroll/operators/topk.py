"""``value_counts(dropna=False).head(n)``, globally or per group, distributed.

Counts are a partial aggregation.  The global top-n is a
``TakeOrderedAndProject`` (each task keeps n rows).  The per-group top-n never
ranks a whole group in one task: a first rank runs per (group, salt) — the
salt is a hash of the value, so one group's distinct values are spread over
``salts`` window partitions — and keeps n rows of each; the final rank then
sees at most ``n × salts`` rows per group.  Ties are broken by the value
(nulls last), so the result does not depend on the salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def top_values(df: DataFrame, value_col: str, n: int, group_cols: tuple[str, ...] = (),
               count_col: str = "rows", salts: int = SALTS) -> DataFrame:
    counts = df.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias(count_col))
    order = [F.col(count_col).desc(), F.col(value_col).asc_nulls_last()]
    if not group_cols:
        top = counts.orderBy(*order).limit(n)
        w = Window.orderBy(*order)   # ≤ n rows after the limit
        return top.withColumn("rank", F.row_number().over(w).cast("bigint"))
    salt = F.pmod(F.xxhash64(F.col(value_col)), F.lit(salts))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    first = (counts.withColumn("_salt", salt)
             .withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= n)
             .drop("_salt", "_r1"))
    w2 = Window.partitionBy(*group_cols).orderBy(*order)   # ≤ n × salts rows per group
    return first.withColumn("rank", F.row_number().over(w2).cast("bigint")).filter(F.col("rank") <= n)
