"""Global order statistics without a single-task window, by one path at any size.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
``running_totals`` range-partitions by the whole sort key instead
(``repartitionByRange``; a tie-breaker in the key lets one hot value span
partitions), stores that frame with each row's partition number, and reads it
twice: once for the totals per partition (as many rows as partitions), once for
the running sums inside each.  The stored partition number makes offsets and rows
agree when a task runs again.

``value_bands`` turns average-tie ranks into score bands: collapse to a value
histogram (a hot value becomes one row), run the totals over distinct values, and
keep per score the smallest and largest value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize


@dataclass(frozen=True)
class Key:
    name: str
    ascending: bool = True

    def order(self) -> Column:
        return F.col(self.name).asc() if self.ascending else F.col(self.name).desc()


def _keys(order) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in order]


def range_partitioned(df: DataFrame, order) -> DataFrame:
    """``df`` in ranges of the sort key, with ``_part``, the number of its range;
    stored, because it is read more than once."""
    keys = _keys(order)
    return materialize(df.repartitionByRange(*[k.order() for k in keys]).withColumn("_part", F.spark_partition_id()))


def running_totals(df: DataFrame, order, sums: list[str] = ()) -> DataFrame:
    """Add, in the total order ``order`` (keys must be non-null):

    * ``row_pos``       1-based position,
    * ``<s>_cum``       inclusive running sum of each column ``s`` in ``sums``,
    * ``total_rows`` and ``<s>_total`` grand totals.
    """
    keys, sums = _keys(order), list(sums)
    ranged = range_partitioned(df, keys)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per_part = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(s).alias(f"_p_{s}") for s in sums])
    # one row per partition: a single-task window and a broadcast of that many rows
    zero = F.lit(0)
    offsets = per_part.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), zero).alias("_off_rows"),
        F.sum("_rows").over(everything).alias("total_rows"),
        *[F.coalesce(F.sum(f"_p_{s}").over(before), zero).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_p_{s}").over(everything).alias(f"{s}_total") for s in sums],
    )
    inside = (Window.partitionBy("_part").orderBy(*[k.order() for k in keys])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = ranged.select("*", F.row_number().over(inside).alias("_in_pos"),
                          *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    return inner.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_off_rows") + F.col("_in_pos")).cast("bigint").alias("row_pos"),
        *[(F.col(f"_off_{s}") + F.col(f"_in_{s}")).alias(f"{s}_cum") for s in sums],
        F.col("total_rows").cast("bigint").alias("total_rows"),
        *[F.col(f"{s}_total") for s in sums],
    )


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct ``value`` (non-null): ``rank_lo`` / ``rank_hi`` (first and
    last 1-based rank of its rows, ascending) and ``rank_n`` (row count)."""
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    return running_totals(hist, [Key(value)], ["_n"]).select(
        value,
        (F.col("_n_cum") - F.col("_n") + 1).cast("bigint").alias("rank_lo"),
        F.col("_n_cum").cast("bigint").alias("rank_hi"),
        F.col("_n_total").cast("bigint").alias("rank_n"),
    )


def value_bands(df: DataFrame, value: str, score: Column) -> DataFrame:
    """(score, low, high): the value range of each score, where ``score`` is a monotone
    expression of (rank_lo, rank_hi, rank_n) with few distinct results."""
    return (value_ranks(df, value).withColumn("score", score).groupBy("score")
            .agg(F.min(value).alias("low"), F.max(value).alias("high")))


def with_score(df: DataFrame, value: str, score: Column, name: str) -> DataFrame:
    """Add the rank score of ``value`` (non-null).  The bands are a handful of rows, so
    they are broadcast; each row falls into exactly one."""
    bands = F.broadcast(value_bands(df, value, score))
    return (df.join(bands, df[value].between(bands["low"], bands["high"]))
            .withColumn(name, F.col("score").cast("int")).drop("score", "low", "high"))
