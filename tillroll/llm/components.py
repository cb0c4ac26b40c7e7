"""Connected components of an edge table by alternating large and small stars.

Each round rewires every edge to the smallest neighbour (large star over both
directions, small star over the downward one); the graph ends as one star per
component.  Edges, rounds and results stay in tables: nothing is collected but a
count and a checksum per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(low, "a").where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .union(low.select("a", F.col("m").alias("b")))
            .distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges`` (a long, b long), any direction, repeats and loops allowed →
    (id long, root long): every node of an edge that is not its component's
    smallest node, with that smallest node.  Rounds grow with the logarithm of
    the component size."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), f"{name}-edges")
    seen = _mark(now)
    while seen[0]:
        now = stored(_small_star(_large_star(now)), f"{name}-stars")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
