"""Exact distribution summaries, distributed, from one value histogram.

``percentile`` in Spark keeps a value→count map of the whole column in one
final task.  Here the columns are collapsed to one histogram of (column, value,
count); ``ranks.running_totals`` gives each value its positions, and everything is
read off that stored frame: moments, extremes, and quantiles from the values at the
two positions around ``(N-1)·q`` — linear interpolation as numpy/pandas do it:
``t < .5 → a + (b-a)·t``, else ``b - (b-a)·(1-t)``.

``describe`` gives pandas' ``describe()`` numbers (count, mean, sample std, min,
quartiles, max).  Values are exact decimals of the column's own scale, of up to 27
digits; more is an error, never a null.  Deviations from a value near the mean are
whole units of the last place, cut into three parts of nine digits, so every sum of
products is exact at any size; the variance numerator n·Σd² − (Σd)² is formed exactly,
or, where it has more than 38 digits, from the exact sums in double.  The result neither
depends on task order nor loses precision when the mean is large against the spread
(a constant column has std exactly 0).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.ranks import Key, running_totals
from tillroll.session import materialize

DESCRIBE_QUANTILES = (0.25, 0.5, 0.75)


def column_scale(kind: T.DataType) -> int:
    """Decimal places of a column's type."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raise ValueError("describe() needs decimals or whole numbers: sums of floating-point values depend on their order")
    return kind.scale if isinstance(kind, T.DecimalType) else 0


DIGITS = 27


def _value(c: str, kind: str) -> Column:
    """A column as ``kind``; a value that doesn't fit stops the job in every ANSI mode."""
    if kind == "double":
        return F.col(c).cast(kind)
    fits = F.col(c).try_cast(kind)
    return F.when(F.col(c).isNotNull() & fits.isNull(), F.raise_error(F.lit(f"{c} has more than {DIGITS} digits"))).otherwise(fits)


def _positions(df: DataFrame, cols: list[str], kind: str) -> DataFrame:
    """One row per column number ``c`` and distinct non-null value ``v`` (as ``kind``):
    its count ``n``, its last position ``last`` among the column's values (from 0), their
    number ``total`` and, of decimals, their sum ``s1``."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), _value(c, kind).alias("v")) for i, c in enumerate(cols)
    ])).alias("s")).select("s.c", "s.v").where("v is not null")
    hist = stacked.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    # the order is by column, then value: a column's positions are the running count
    # less what its first value has before it
    ranked = running_totals(hist, [Key("c"), Key("v")], ["n"])
    sums = [] if kind == "double" else [F.sum(F.col("n").cast(_TIMES) * F.col("v")).alias("s1")]
    first = ranked.groupBy("c").agg(F.min(F.col("n_cum") - F.col("n")).alias("start"), F.sum("n").alias("total"), *sums)
    # one row a column: a bounded broadcast
    return ranked.join(F.broadcast(first), "c").select(
        "c", "v", "n", (F.col("n_cum") - 1 - F.col("start")).alias("last"), "total", *[F.col("s1") for _ in sums])


_TIMES = "decimal(18,0)"
#: Products of the three parts (of 9 digits each, highest first) of a deviation, with the
#: power of ten and the factor that each has in its square.
_PRODUCTS = [("x", "x", 36, 1), ("x", "y", 27, 2), ("x", "z", 18, 2), ("y", "y", 18, 1), ("y", "z", 9, 2), ("z", "z", 0, 1)]


def _exact(terms: list[tuple[Column, int]]) -> Column:
    """The sum of column * factor as decimal(38,0); null where it has more digits."""
    whole = "decimal(38,0)"
    parts = [F.try_multiply(c.cast(whole), F.lit(Decimal(f)).cast(whole)) if f != 1 else c.cast(whole) for c, f in terms]
    return reduce(F.try_add, parts)


def _double(terms: list[tuple[Column, int]]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("double") * float(f) for c, f in terms])


def _lerp(a: Column, b: Column, t: Column) -> Column:
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def _quantile(q: float) -> Column:
    """The q-quantile as an aggregate over a column's rows of ``_positions``."""
    at = (F.col("total") - 1).cast("double") * q
    low, high = F.floor(at), F.least(F.floor(at) + 1, F.col("total") - 1)
    value = F.col("v").cast("double")
    # the value at a position is the smallest whose last position reaches it
    a, b = (F.min(F.when(F.col("last") >= p, value)) for p in (low, high))
    return _lerp(a, b, F.max(at - low))


def exact_quantiles(df: DataFrame, col: str, qs) -> DataFrame:
    """Rows (quantile, value) for each q in ``qs`` (linear interpolation)."""
    found = _positions(df, [col], "double").groupBy("c").agg(*[_quantile(float(q)).alias(f"q{i}") for i, q in enumerate(qs)])
    return found.select(F.explode(F.array(*[
        F.struct(F.lit(float(q)).alias("quantile"), F.col(f"q{i}").alias("value")) for i, q in enumerate(qs)])).alias("s")).select("s.*")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: column, count, mean, std, min, p25, p50, p75, max.

    The input is read once, for the histogram.  No digit of the sums is lost."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    scale = max(column_scale(kinds[c]) for c in cols)
    if scale > 6:
        raise ValueError("describe() keeps six decimal places")
    stats = _positions(df, cols, f"decimal({DIGITS},{scale})")
    # any value near the mean will do: the spread is the same about each
    centre = (F.col("s1") / F.col("total")).cast(f"decimal({DIGITS},{scale})")
    stats = stats.withColumn("d", ((F.col("v") - centre) * 10 ** scale).cast(f"decimal({DIGITS + 1},0)"))
    times = F.col("n").cast(_TIMES)
    stats = stats.select("*", F.signum(F.col("d").cast("double")).cast("int").alias("sign"),
                         *[F.expr(e).cast("bigint").alias(part) for part, e in (
                             ("x", "abs(d) div 1000000000000000000"), ("y", "(abs(d) div 1000000000) % 1000000000"),
                             ("z", "abs(d) % 1000000000"))])
    per_col = stats.groupBy("c").agg(
        F.max("total").alias("count"), F.max("s1").alias("s1"),
        *[F.sum(times * F.col("sign") * F.col(p)).alias(f"d{p}") for p in "xyz"],
        *[F.sum(times * (F.col(p) * F.col(q)).cast("decimal(18,0)")).alias(f"d{p}{q}") for p, q, _, _ in _PRODUCTS],
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"),
        *[_quantile(q).alias(name) for q, name in zip(DESCRIBE_QUANTILES, ("p25", "p50", "p75"))])
    n = F.col("count").cast("double")
    first = [(F.col(f"d{p}"), 10 ** e) for p, e in (("x", 18), ("y", 9), ("z", 0))]
    square = [(F.col(f"d{p}{q}"), factor * 10 ** e) for p, q, e, factor in _PRODUCTS]
    whole = F.col("count").cast("decimal(38,0)")
    exact = F.try_subtract(F.try_multiply(whole, _exact(square)), F.try_multiply(_exact(first), _exact(first))).cast("double")
    # more than 38 digits: deviations are then so large that the second term hardly counts
    spread = F.coalesce(exact, n * _double(square) - _double(first) * _double(first))
    var = spread / F.when(n > 1, n * (n - 1)) / float(10 ** (2 * scale))
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "c int, column string")
    # one row a column on both sides
    return names.join(F.broadcast(per_col), "c", "left").select(
        "column", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), (F.col("s1").cast("double") / n).alias("mean"),
        F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"), "min", "p25", "p50", "p75", "max")


def equal_width_histogram(df: DataFrame, col: str, bins: int, upper: Column | float | None = None) -> DataFrame:
    """numpy ``histogram(x, bins)``: equal-width bins over [min, max], the last
    bin closed.  Rows: bin (1..bins), bin_start, bin_end, count (zero bins kept)."""
    spark = df.sparkSession
    x = F.col(col).cast("double")
    data = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    if upper is not None:
        data = data.filter(F.col("_x") <= (upper if isinstance(upper, Column) else F.lit(upper)))
    rng = data.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    # one-row range table → bounded broadcast.
    binned = data.crossJoin(F.broadcast(rng)).select(
        F.when(F.col("_hi") == F.col("_lo"), F.lit(1))
         .otherwise(F.least(F.floor((F.col("_x") - F.col("_lo")) * (F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))))
                            + 1, F.lit(bins))).cast("int").alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    labels = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    # counts has at most `bins` rows: bounded broadcast
    return (labels.crossJoin(F.broadcast(rng))
            .join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    (F.col("_lo") + (F.col("bin") - 1) * width).alias("bin_start"),
                    (F.col("_lo") + F.col("bin") * width).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def tail_histogram(df: DataFrame, col: str, bins: int, q: float) -> DataFrame:
    """``equal_width_histogram`` of the values at or below the ``q``-quantile, with that
    value as ``cut_value``.  The input is read once: the cut, the range and the bins all
    come from its stored histogram of values."""
    values = materialize(_positions(df, [col], "double"))
    # one row each: bounded broadcasts
    cut = values.groupBy("c").agg(_quantile(q).alias("cut_value")).select("cut_value")
    kept = values.crossJoin(F.broadcast(cut)).where("v <= cut_value")
    rng = kept.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("cut_value").alias("cut_value"))
    place = F.floor((F.col("v") - F.col("low")) * (F.lit(float(bins)) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)))) + 1
    counts = (kept.drop("cut_value").crossJoin(F.broadcast(rng))
              .groupBy(F.when(F.col("high") > F.col("low"), F.least(place, F.lit(bins))).otherwise(1).cast("int").alias("bin")).agg(F.sum("n").alias("count")))
    width = (F.col("high") - F.col("low")) / bins
    labels = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    # at most ``bins`` rows
    return labels.crossJoin(F.broadcast(rng)).join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.col("low") + (F.col("bin") - 1) * width).alias("bin_start"), (F.col("low") + F.col("bin") * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "cut_value")
