"""Which rows may have an equal row: two-bit counts of row hashes, merged over tasks.

Finding exact repeats by grouping moves every row, although nearly every group has one.
Here only 64-bit hashes of rows are counted, in cells that know zero, one and more, two
cells a hash.  Tasks send the cells they touched, page by page; pages are merged in
tasks; the whole (at most ``MOST_CELLS`` cells in each of two rows, 128 MB) is sent to
the tasks.  A row of which one cell was touched once has no equal.  All others are
*suspects*, to be compared exactly: equal rows touch the same cells, so none is missed.

With eight cells a row about 1.4 rows in a hundred are suspects without need; a table
of more rows than an eighth of ``MOST_CELLS`` has more of them, and the same result."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 1 << 16
MOST_CELLS = 1 << 28
HELD = 1 << 19  # rows whose cells a task sorts at once


@dataclass(frozen=True)
class RepeatFilter:
    """Counts of the row hashes over ``columns``."""

    columns: tuple[str, ...]
    width: int
    cells: object  # the broadcast counts as bytes, four cells a byte

    def suspect(self) -> Column:
        """True where the row may have an equal in the table that was counted.  Only the
        hash goes through Python."""
        sent, width = self.cells, self.width

        @F.arrow_udf("boolean")
        def twice(h: pa.Array) -> pa.Array:
            # bytes are read once into a worker; an array would be held twice while it loads
            counts, x = np.frombuffer(sent.value, np.uint8), h.to_numpy(zero_copy_only=False).view(np.uint64)
            out = np.ones(len(x), bool)
            for row, shift in ((0, 0), (1, 32)):
                at = ((x >> np.uint64(shift)) & np.uint64(width - 1)).astype(np.int64) + row * width
                out &= (counts[at >> 2] >> ((at & 3) << 1).astype(np.uint8) & 3) > 1
            return pa.array(out)

        return twice(F.xxhash64(*self.columns))


def repeat_filter(df: DataFrame, columns: list[str], most_cells: int = MOST_CELLS) -> RepeatFilter:
    """Counts the rows of ``df`` (a stored table: it is read again for its suspects) by the
    hash of ``columns``, nulls equal."""
    rows, width = df.count(), min(PAGE, most_cells)  # powers of two
    while width < min(8 * rows, most_cells):
        width *= 2
    page, cell = PAGE, np.uint32 if 2 * width <= 1 << 32 else np.uint64

    def count(batches):
        def table(cells):
            cells, n = np.unique(cells, return_counts=True)
            pages, starts = np.unique(cells // page, return_index=True)
            low, more, ends = (cells % page).astype("<u2"), n > 1, [*starts[1:].tolist(), len(cells)]
            parts = [(low[a:b], more[a:b]) for a, b in zip(starts.tolist(), ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(pages, pa.int32()), pa.array([x[~m].tobytes() for x, m in parts], pa.binary()),
                 pa.array([x[m].tobytes() for x, m in parts], pa.binary())], ["page", "once", "more"])

        held, n = [], 0
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            held += [((x >> np.uint64(shift)) & np.uint64(width - 1)).astype(cell) + cell(row * width) for row, shift in ((0, 0), (1, 32))]
            n += len(x)
            if n >= HELD:
                yield table(np.concatenate(held))
                held, n = [], 0
        if n:
            yield table(np.concatenate(held))

    def merge(batches):
        def packed(number, cells):
            four = cells.reshape(-1, 4)
            data = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data], pa.binary())], ["page", "data"])

        number, cells = None, None
        for batch in batches:
            for p, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                if p != number:
                    if number is not None:
                        yield packed(number, cells)
                    number, cells = p, np.zeros(page, np.uint8)
                x = np.frombuffer(once, "<u2")
                cells[x] = np.minimum(cells[x] + 1, 2)
                cells[np.frombuffer(more, "<u2")] = 2
        if number is not None:
            yield packed(number, cells)

    pages = (df.select(F.xxhash64(*columns).alias("h")).mapInArrow(count, "page int, once binary, more binary")
             .repartition("page").sortWithinPartitions("page").mapInArrow(merge, "page int, data binary"))
    counts = np.zeros(-(-2 * width // PAGE) * PAGE // 4, np.uint8)
    for row in pages.collect():  # at most 2 * MOST_CELLS / 4 bytes
        counts[row["page"] * PAGE // 4:(row["page"] + 1) * PAGE // 4] = np.frombuffer(row["data"], np.uint8)
    return RepeatFilter(tuple(columns), width, df.sparkSession.sparkContext.broadcast(counts.tobytes()))
