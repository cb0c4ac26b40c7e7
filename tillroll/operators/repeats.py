"""Exact-repeat count per line without a window over a hot group.

``COUNT(*) OVER (PARTITION BY <every column>)`` sends each group of identical
rows to one task; a group holding a third of the data would then be one task.
Because the partition key is the whole row, the same result comes from collapsing
identical rows (partial aggregation on the map side) and expanding each distinct
row back.  The expansion is in two steps for every group: first into pieces of at
most ``PIECE_ROWS`` copies, which a rebalance hint spreads evenly over tasks, then
each piece into its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies that one piece stands for.
PIECE_ROWS = 4096


def with_repeat_count(df: DataFrame, count_col: str = "repeat_count") -> DataFrame:
    """Every row of ``df`` (nulls equal), plus how many identical rows it has."""
    cols = df.columns
    n = F.col(count_col)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count_col))
    pieces = groups.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                              ((n - 1) / PIECE_ROWS).cast("bigint")))).hint("rebalance")
    left = F.least(n - F.col("_piece") * PIECE_ROWS, F.lit(PIECE_ROWS).cast("bigint"))
    return (pieces.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
            .select(*cols, count_col))
