"""Quantiles of a declared error from mergeable counts, for inputs of any size.

Whole units of a decimal's last place are counted in cells that keep the leading
``BITS`` + 1 binary digits: a cell's width is at most 1 / 2^BITS of its values, small
values have cells of their own, and there are at most 2^BITS cells for each power of
two.  Counts of two inputs add up to those of both, so a sketch is stored per month and
merged for any range of months.  No float enters a cell: the counts do not depend on
order, and any engine gives the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 7


def cell_of(units: Column, bits: int = BITS) -> tuple[Column, Column]:
    """(low, width) of the cell that holds a whole number: its bounds are ``low`` and, away
    from zero, ``width`` - 1 further."""
    size = F.abs(units)
    dropped = F.greatest(F.length(F.bin(size)) - (bits + 1), F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, dropped), dropped)
    return F.when(units < 0, -low).otherwise(low), F.call_function("shiftleft", F.lit(1).cast("long"), dropped)


def sketch(df: DataFrame, value: str, scale: int, group: list[Column] = (), bits: int = BITS) -> DataFrame:
    """(groups, low, width, n): how many non-null values of ``value`` (a decimal of
    ``scale`` places) lie in each cell."""
    units = (F.col(value) * 10 ** scale).cast("bigint")
    low, width = cell_of(units, bits)
    return (df.where(F.col(value).isNotNull()).select(*group, low.alias("low"), width.alias("width"))
            .groupBy(*[F.col(c) for c in df.select(*group).columns], "low", "width").agg(F.count(F.lit(1)).alias("n")))


def merged(sketches: DataFrame) -> DataFrame:
    """(low, width, n) of stored sketches, whatever their groups."""
    return sketches.groupBy("low", "width").agg(F.sum("n").alias("n"))


def approx_quantiles(cells: DataFrame, qs, scale: int) -> DataFrame:
    """(quantile, value, low, high, rank_bound): for each q the value at position
    floor((N - 1) q) of the sorted values, guessed inside its cell; the true one lies in
    [low, high], and the guess is at most ``rank_bound`` (the cell's share of N) away in rank."""
    # at most 2 * 64 * 2^BITS cells: a bounded window
    order = Window.orderBy("low")
    ranked = cells.select("low", "width", "n", (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"))
    asked = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("quantile")
    at = F.floor((F.col("all") - 1).cast("double") * F.col("quantile"))
    hit = ranked.select("*", asked).withColumn("at", at).where((F.col("before") <= F.col("at")) & (F.col("at") < F.col("before") + F.col("n")))
    unit = float(10 ** scale)
    away = F.when(F.col("low") < 0, -1).otherwise(1) * (F.col("width") - 1)
    first, last = F.least(F.col("low"), F.col("low") + away), F.greatest(F.col("low"), F.col("low") + away)
    inside = (F.col("at") - F.col("before") + 0.5) / F.col("n")
    return hit.select("quantile", ((first + F.floor((last - first) * inside)) / unit).alias("value"), (first / unit).alias("low"),
                      (last / unit).alias("high"), (F.col("n") / F.col("all")).alias("rank_bound"))
