"""The first rows of several lists in one read.

Every task keeps, for each list, the ``n`` first rows it has seen (never more than that
and one batch); a second task per list merges those of all tasks.  The table is read
once, however many lists there are, and never sorted: a batch's rows that come after a
list's n-th row are passed over by their first sort column."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TopList:
    name: str
    where: Column
    order: tuple[tuple[str, bool], ...]  # (column, ascending); nulls first
    n: int


def top_lists(df: DataFrame, lists: Iterable[TopList], columns: list[str]) -> DataFrame:
    """(list_name, rank, columns): the first ``n`` rows of each list among the rows of its
    condition, in its order, nulls first; rank from 1.  The order should be total."""
    lists = list(lists)
    keys = list(dict.fromkeys([c for x in lists for c, _ in x.order]))
    extra = [c for c in keys if c not in columns]
    flags = [f"_in{k}" for k in range(len(lists))]
    wanted = df.select(*columns, *extra, *[F.coalesce(x.where, F.lit(False)).alias(f) for x, f in zip(lists, flags)])
    wanted = wanted.where(" or ".join(flags))
    names = [*columns, *extra]
    specs = [(x.name, tuple((c, "ascending" if up else "descending") for c, up in x.order), x.n) for x in lists]
    fields = [f for c in names for f in wanted.schema.fields if f.name == c]
    held = T.StructType([T.StructField("list", T.IntegerType()), *fields])
    out = T.StructType([T.StructField("list_name", T.StringType()), T.StructField("rank", T.LongType()), *fields])

    def first(table, order, n):
        if table.num_rows > n:
            table = table.take(pc.sort_indices(table, sort_keys=list(order), null_placement="at_start")[:n])
        return table

    def keep(batches):
        best = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k, (_, order, n) in enumerate(specs):
                rows = table.filter(table.column(f"_in{k}")).select(names)
                have = best.get(k)
                if have is not None and have.num_rows == n and rows.num_rows:
                    column, way = order[0]
                    last = have.take(pc.sort_indices(have, sort_keys=list(order), null_placement="at_start")).column(column)[n - 1]
                    if last.is_valid:  # rows that tie with it, or are null, may still come before
                        beyond = (pc.greater if way == "ascending" else pc.less)(rows.column(column), last)
                        rows = rows.filter(pc.invert(pc.fill_null(beyond, False)))
                if rows.num_rows:
                    best[k] = first(rows if have is None else pa.concat_tables([have, rows]), order, n).combine_chunks()
        for k, rows in best.items():
            yield from rows.add_column(0, "list", pa.array([k] * rows.num_rows, pa.int32())).to_batches()

    def merge(batches):
        best = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for k in pc.unique(table.column("list")).to_pylist():
                rows = table.filter(pc.equal(table.column("list"), k)).select(names)
                best[k] = first(pa.concat_tables([best[k], rows]) if k in best else rows, specs[k][1], specs[k][2])
        for k, rows in best.items():
            name, order, _ = specs[k]
            rows = rows.take(pc.sort_indices(rows, sort_keys=list(order), null_placement="at_start"))
            rows = rows.add_column(0, "rank", pa.array(range(1, rows.num_rows + 1), pa.int64()))
            yield from rows.add_column(0, "list_name", pa.array([name] * rows.num_rows, pa.string())).combine_chunks().to_batches()

    # at most n rows a list and task are moved
    return (wanted.mapInArrow(keep, held).repartition(len(lists), "list").mapInArrow(merge, out)
            .select("list_name", "rank", *columns))
