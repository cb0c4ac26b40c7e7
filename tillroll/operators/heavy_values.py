"""The most frequent values without grouping all values.

First pass: every task keeps a summary of at most ``COUNTERS`` values.  When it has more,
the next largest count is taken from all of them and the empty ones go (Misra-Gries), so
a value's counter is too low by at most what was taken so far, and a value without a
counter occurred no more often than that.  Counters and errors of the tasks add up.

Second pass: an exact count of the candidates, which are the values whose counter plus
the total error reaches the n-th largest counter.  No value is lost: the n-th largest
true count is no smaller than that counter, and a value that isn't a candidate stays
below it.  If the total error reaches that counter itself, values without a counter might
count, and all values are grouped instead."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.topk import top_values
from tillroll.session import materialize

COUNTERS = 1 << 14
BROADCAST_ROWS = 1_000_000


def summary(df: DataFrame, value_col: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n, taken): counters of all tasks, and one row a task (``taken`` not null) with
    the most that a counter of that task can lack.  Nulls are counted as a value."""
    def run(batches):
        held, taken = None, 0
        for batch in batches:
            counts = pc.value_counts(batch.column(0))
            table = pa.table({"v": counts.field(0), "n": counts.field(1)})
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows > 4 * counters:
                held = held.group_by("v").aggregate([("n", "sum")]).rename_columns(["v", "n"])
                if held.num_rows > counters:
                    least = pc.sort_indices(held, sort_keys=[("n", "descending")])[counters].as_py()
                    least = held.column("n")[least].as_py()
                    taken += least
                    held = held.set_column(1, "n", pc.subtract(held.column("n"), least))
                    held = held.filter(pc.greater(held.column("n"), 0))
        if held is not None:
            held = held.group_by("v").aggregate([("n", "sum")]).rename_columns(["v", "n"]).combine_chunks()
            rows = held.num_rows
            yield from pa.table({"value": held.column("v"), "n": held.column("n"), "taken": pa.nulls(rows, pa.int64())}).to_batches()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([0], pa.int64()), pa.array([taken], pa.int64())], ["value", "n", "taken"])

    return df.select(F.col(value_col).cast("string").alias("value")).mapInArrow(run, "value string, n long, taken long")


def top_heavy_values(df: DataFrame, value_col: str, n: int, count_col: str = "rows", counters: int = COUNTERS) -> DataFrame:
    """``top_values(df, value_col, n)`` of a string column: the same rows, ties by value."""
    found = materialize(summary(df, value_col, counters))
    counts = found.where("taken is null").groupBy("value").agg(F.sum("n").alias("n"))
    # the n largest counters, and one row of totals
    facts = counts.select("n", F.lit(None).cast("long").alias("error")).orderBy(F.col("n").desc()).limit(n).union(
        found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("taken"), F.lit(0)))).collect()
    total, error = next((r["n"], r["error"]) for r in facts if r["error"] is not None)
    nth = [r["n"] for r in facts if r["error"] is None]
    least = min(nth) - error if len(nth) == n else -error
    if error and least <= 0:
        return top_values(df, value_col, n, count_col=count_col)
    candidates = counts.where(F.col("n") >= least).select(F.col("value").alias("_value"))
    # counters of at least this much are no more than total / least
    few = total <= BROADCAST_ROWS * max(least, 1)
    sent = F.broadcast(candidates) if few else candidates
    return top_values(df.join(sent, F.col(value_col).eqNullSafe(F.col("_value")), "left_semi"), value_col, n, count_col=count_col)
