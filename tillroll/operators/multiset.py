"""Multiset equality of two tables without moving their rows.

Rows of both sides collapse, where they lie, to one row per key with the copies on each
side and two signed sums of row hashes; sums do not depend on order, so they are merged
like counts.  A key of which both sums (128 bits in all) and the copies balance holds the
same rows on both sides; only the rows of other keys are moved and compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Rows of a key each that may be sent to every task (a few dozen bytes a row).
BROADCAST_ROWS = 1_000_000


def _hash(cols: list[str], seed: int) -> Column:
    """A row's hash; nulls count (Spark's own hash passes over them)."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("long") * (1 << k) for k, c in enumerate(cols)])
    return F.xxhash64(F.lit(seed), nulls, *cols).cast("decimal(20,0)")


def compare_multisets(a: DataFrame, b: DataFrame, cols: list[str], key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, rows): per ``key`` (part of ``cols``, nulls equal) the copies ``rows_a`` and
    ``rows_b`` on each side and whether it is ``balanced``; and the distinct rows of the
    keys that aren't, with ``rows_a`` and ``rows_b``."""
    both = a.select(*cols, F.lit(1).alias("_side")).unionByName(b.select(*cols, F.lit(-1).alias("_side")))
    one, two = (F.sum(_hash(cols, seed) * F.col("_side")) for seed in (1, 2))
    copies = [F.count_if(F.col("_side") == 1).alias("rows_a"), F.count_if(F.col("_side") == -1).alias("rows_b")]
    keys = materialize(both.groupBy(*key).agg(*copies, one.alias("_one"), two.alias("_two")).select(
        *key, "rows_a", "rows_b", ((F.col("_one") == 0) & (F.col("_two") == 0) & (F.col("rows_a") == F.col("rows_b"))).alias("balanced")))
    apart = keys.where("not balanced").select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)])
    few = apart.count() <= BROADCAST_ROWS
    rows = both.join(F.broadcast(apart) if few else apart, same, "left_semi").groupBy(*cols).agg(*copies)
    return keys, rows
