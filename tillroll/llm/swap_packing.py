"""Best-fit packing with a swap-based local search, on counts of lengths.

Pieces of one length are interchangeable, so the packing is planned on the
histogram of lengths: at most ``capacity`` counts, whatever the corpus size.  Bins
that hold the same lengths form one class with a count; best fit and every
exchange act on whole classes.  The plan is a list of rank ranges per length; each
piece finds its place from its rank among the pieces of its length, which Spark
computes per hash bucket plus a prefix over buckets (a length held by a third of
all rows is spread over all buckets)."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.bpe_codec import token_pieces
from tillroll.llm.store import shuffle_width, stored


class Bins:
    """Classes of equal bins: lengths held (descending) → number of bins."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count: Counter[tuple[int, ...]] = Counter()
        self.by_free: dict[int, set[tuple[int, ...]]] = {}

    def add(self, items: tuple[int, ...], n: int) -> None:
        if not items or not n:
            return
        self.count[items] += n
        self.by_free.setdefault(self.capacity - sum(items), set()).add(items)

    def take(self, items: tuple[int, ...], n: int) -> None:
        self.count[items] -= n
        if not self.count[items]:
            del self.count[items]
            self.by_free[self.capacity - sum(items)].discard(items)

    def best_fit(self, length: int, n: int) -> None:
        """Put ``n`` pieces, each into the fullest bin that has room, else a new one."""
        while n:
            free = next((f for f in range(length, self.capacity) if self.by_free.get(f)), None)
            if free is None:
                per = self.capacity // length
                self.add((length,) * per, n // per)
                self.add((length,) * (n % per), 1)
                return
            host = min(self.by_free[free])
            room = free // length
            k = min(self.count[host], n // room)
            if not k:  # fewer pieces than one bin has room for
                room, k = n, 1
            self.take(host, k)
            self.add(tuple(sorted(host + (length,) * room, reverse=True)), k)
            n -= k * room


def _less(items: tuple[int, ...], *drop: int) -> tuple[int, ...]:
    left = list(items)
    for x in drop:
        left.remove(x)
    return tuple(left)


def _sorted(items) -> tuple[int, ...]:
    return tuple(sorted(items, reverse=True))


class _Offers:
    """What underfull classes can give away: one piece, or two at once."""

    def __init__(self, bins: Bins, but: tuple[int, ...]):
        rows = []
        for free, classes in bins.by_free.items():
            if free:
                for c in classes:
                    if c != but:
                        rows.append((c, (), 0, free))
                        distinct = sorted(set(c))
                        rows += [(c, (y,), y, free) for y in distinct]
                        rows += [(c, (y, z), y + z, free) for i, y in enumerate(distinct) for z in distinct[i:]
                                 if y != z or c.count(y) > 1]
        rows.sort(key=lambda r: (r[3], r[0], r[1]))
        self.rows = rows
        self.give = np.array([r[2] for r in rows], np.int64)
        self.free = np.array([r[3] for r in rows], np.int64)
        self.size = np.array([len(r[1]) for r in rows], np.int64)


def _exchange(bins: Bins, weak: tuple[int, ...]):
    """The exchange (x pieces of ``weak`` for y pieces of a fuller bin: 1-0, 1-1,
    2-1 or 1-2) with the largest gain in squared fill, or None."""
    offers = _Offers(bins, weak)
    if not offers.rows:
        return None
    fill_w = sum(weak)
    fill_b = bins.capacity - offers.free
    best, found = 0, None
    distinct = sorted(set(weak))
    outs = [(x,) for x in distinct] + [(x, z) for i, x in enumerate(distinct) for z in distinct[i:]
                                       if x != z or weak.count(x) > 1]
    for out in outs:
        d = sum(out) - offers.give
        ok = (d > 0) & (d <= offers.free) & (offers.size <= (2 if len(out) == 1 else 1)) \
            & ((len(out) == 1) | (offers.size == 1))
        gain = np.where(ok, (fill_b + d) ** 2 - fill_b ** 2 + (fill_w - d) ** 2 - fill_w ** 2, 0)
        k = int(gain.argmax())
        if gain[k] > best:
            best, found = int(gain[k]), (out, *offers.rows[k][:2])
    return found


def plan(histogram: dict[int, int], capacity: int, patience: int = 64) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, number of bins) for ``histogram`` (length → pieces).

    Best fit in decreasing order, then local search: the emptiest bin gives pieces
    to fuller ones by the exchange that raises squared fill most, until it is empty
    or stuck.  It ends at the lower bound, or after ``patience`` stuck bins."""
    bins = Bins(capacity)
    for length in sorted(histogram, reverse=True):
        bins.best_fit(length, histogram[length])
    least = -(-sum(k * n for k, n in histogram.items()) // capacity)
    stuck: set[tuple[int, ...]] = set()
    while sum(bins.count.values()) > least and len(stuck) < patience:
        weak = min((c for f, cs in bins.by_free.items() if f for c in cs if c not in stuck),
                   key=lambda c: (sum(c), c), default=None)
        if weak is None:
            break
        while weak:
            found = _exchange(bins, weak)
            if found is None:
                stuck.add(weak)
                break
            out, host, back = found
            n = min(bins.count[weak], bins.count[host])
            bins.take(weak, n)
            bins.take(host, n)
            bins.add(_sorted(_less(host, *back) + out), n)
            weak = _sorted(_less(weak, *out) + back)
            bins.add(weak, n)
            if sum(bins.count.values()) <= least:
                break
    return sorted(bins.count.items(), reverse=True)


def _places(classes: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each range, its first sequence id, its offset."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter[int] = Counter()
    base = 0
    for items, n in classes:
        offset = 0
        for length in items:
            out.setdefault(length, []).append((taken[length], base, offset))
            taken[length] += n
            offset += length
        base += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in out.items()}


def ranked(pieces: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``_rank``: the place of each piece among those of its length, from 0."""
    buckets = shuffle_width(pieces.sparkSession)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("_bucket", "length").agg(F.count(F.lit(1)).alias("_n"))
             .select("_bucket", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    within = Window.partitionBy("_bucket", "length").orderBy(*order)
    return (dealt.withColumn("_rank", F.row_number().over(within) - 1)
            .join(first, ["_bucket", "length"])
            .withColumn("_rank", F.col("_rank") + F.col("_first")).drop("_bucket", "_first"))


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """Adds sequence_id and offset (both long) to ``pieces``, a *stored* table with a
    long column ``length`` in 1..capacity.  Every piece gets one place; a sequence's
    pieces fill it gapless from offset 0.  An empty table gives an empty one."""
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan(counts, capacity))
    rows = ranked(pieces, order)
    schema = rows.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")
    at_length, at_rank = rows.columns.index("length"), rows.columns.index("_rank")

    def put(batches):
        for b in batches:
            lengths, ranks = (b.column(k).to_numpy(zero_copy_only=False) for k in (at_length, at_rank))
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order_by = np.argsort(lengths, kind="stable")
            cut = np.flatnonzero(np.diff(lengths[order_by])) + 1
            for own in np.split(order_by, cut):
                if len(own):
                    start, base, place = places[int(lengths[own[0]])]
                    k = np.searchsorted(start, ranks[own], side="right") - 1
                    sequence[own] = base[k] + ranks[own] - start[k]
                    offset[own] = place[k]
            keep = [k for k in range(b.num_columns) if k != at_rank]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.array(sequence), pa.array(offset)],
                                             schema.names)

    return rows.mapInArrow(put, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack whole documents (ids and ``end_id``; only those beyond ``capacity`` are
    cut) into sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of length 1; repeated rows are packed as often
    as they come; null ids keep their row; further columns are not read."""
    pieces = stored(token_pieces(docs, path, capacity, end_id), "pieces")
    return pack(pieces, capacity, ["doc_id", "piece", "length", "ids_crc32"])


def sequence_ids(docs: DataFrame, placed: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids binary little-endian 32 bit)
    for ``placed`` = pack_documents(docs); doc_id must be unique and not null here."""
    texts = token_pieces(docs, path, capacity, end_id, keep_ids=True).select("doc_id", "piece", "ids")
    return (placed.join(texts, ["doc_id", "piece"]).groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
