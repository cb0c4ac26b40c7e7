"""The trie of conversation prefixes, without shuffling the tails that nothing shares.

A node is a distinct sequence of first turns; a chained 128-bit digest names it.  A
count-min sketch of all prefix digests screens them: a cell counts no digest too few, so
an estimate of one proves that a single conversation has this prefix, and with it every
longer one.  Such tails become nodes in the task that holds them.  Only prefixes that may
be shared are shuffled, and grouped exactly.

Sums over a subtree need no walk down the trie.  Every node belongs to its smallest
member; a conversation owns all its nodes from some depth on.  What a subtree holds is
then a sum over the members of its top, each adding what lies between the top and the
depth where its own nodes begin.

Texts never leave the task that reads them: digests and lengths do."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.store import ship, stored

ROOT = (0, 0)            # the digest of no turns
BLOCK = 512              # turns of one conversation that travel as one row
IDS = 12                 # 2^12 neighbouring ids are joined to a text before the rest of the sort
PAGE = 1 << 16           # cells of the sketch that are merged as one row
MOST_CELLS = 1 << 27     # in each of the two rows of the sketch: 64 MB for both at two bits a cell
_NODE = "depth: int, k1: long, k2: long, p1: long, p2: long, before: long, chars: int, ends: boolean"
_NODE_ARROW = pa.struct([("depth", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                         ("before", pa.int64()), ("chars", pa.int32()), ("ends", pa.bool_())])


def digest(role: str, text: str) -> bytes:
    role = role.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(struct.pack("<Q", len(role)) + role + text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv_id, turn, a, b, chars): each turn's digest and code points, for rows with a conv_id."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x = batch.slice(at, 2048)
                texts = [t or "" for t in x.column(3).to_pylist()]
                raw = b"".join(digest(r or "", t) for r, t in zip(x.column(2).to_pylist(), texts))
                ab = np.frombuffer(raw, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy()),
                                                  pa.array([len(t) for t in texts], pa.int32())], ["conv_id", "turn", "a", "b", "chars"])

    ship(conversations.sparkSession)
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    return rows.where("conv_id is not null").mapInArrow(run, "conv_id long, turn long, a long, b long, chars int")


def _order() -> list:
    return [F.asc_nulls_first("turn"), F.asc("a"), F.asc("b")]


def _blocks(rows: DataFrame, skipped: Callable[[int], int]) -> DataFrame:
    """(conv_id, last, upto, nodes): for (conv_id, own, turn, a, b, chars) the prefixes of
    every conversation in runs of ``BLOCK``.  ``upto``: code points up to the run's end."""
    def run(batches):
        out: list[tuple] = []      # (conv_id, last, upto, depth of the first node, digests, lengths)
        conv, at, own, key, total, first, keys, sizes = None, 0, 0, ROOT, 0, 0, [], []

        def close(last: bool) -> None:
            nonlocal first, keys, sizes
            if conv is not None:
                out.append((conv, last, total, first, before, keys, sizes))
            first, keys, sizes = at, [], []

        def table() -> pa.RecordBatch:
            flat = sum(len(x[6]) for x in out)
            depth = np.empty(flat, np.int32)
            k = np.empty((flat, 2), np.int64)
            p = np.empty((flat, 2), np.int64)
            bef, chars, ends = np.empty(flat, np.int64), np.empty(flat, np.int32), np.zeros(flat, bool)
            offsets, o = [0], 0
            for _, last, upto, start, parent, ks, cs in out:
                n = len(cs)
                if n:
                    depth[o:o + n] = np.arange(start + 1, start + n + 1)
                    k[o:o + n] = ks
                    p[o], p[o + 1:o + n] = parent, k[o:o + n - 1]
                    c = np.array(cs, np.int64)
                    chars[o:o + n] = c
                    bef[o:o + n] = upto - np.cumsum(c[::-1])[::-1]
                    ends[o + n - 1] = last
                o += n
                offsets.append(o)
            nodes = pa.StructArray.from_arrays([pa.array(x) for x in (depth, k[:, 0].copy(), k[:, 1].copy(), p[:, 0].copy(),
                                                                     p[:, 1].copy(), bef, chars, ends)], fields=list(_NODE_ARROW))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out]),
                                               pa.array([x[2] for x in out], pa.int64()),
                                               pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes)],
                                              ["conv_id", "last", "upto", "nodes"])

        before, skip = ROOT, 0     # the digest before the run's first node; own turns to leave out
        pack, blake = struct.Struct("<qqqq").pack, hashlib.blake2b
        held = 0
        for batch in batches:
            for c, mine, a, b, n in zip(*(x.to_pylist() for x in batch.columns)):
                if c != conv:
                    close(True)
                    conv, at, own, key, total, first, before = c, 0, 0, ROOT, 0, 0, ROOT
                    skip = skipped(c)
                if mine:
                    own += 1
                    if own <= skip:
                        continue
                if len(sizes) == BLOCK:
                    close(False)
                    before = key
                key = struct.unpack("<qq", blake(pack(*key, a, b), digest_size=16).digest())
                keys.append(key)
                sizes.append(n)
                total += n
                at += 1
                held += 1
            if held >= 20_000 and out:
                yield table()
                out.clear()
                held = 0
        close(True)
        if out:
            yield table()

    return rows.select("conv_id", "own", "a", "b", "chars").mapInArrow(run, f"conv_id long, last boolean, upto long, nodes array<struct<{_NODE}>>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests (k1, k2) of all nodes of a batch of blocks, and the number of nodes a block."""
    lists = batch.column(batch.num_columns - 1)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    nodes = lists.flatten()
    return nodes.field(1).to_numpy().view(np.uint64), nodes.field(2).to_numpy().view(np.uint64), sizes


def _cells(key: np.ndarray, width: int) -> np.ndarray:
    return (key & np.uint64(width - 1)).astype(np.int64)


def _sketch(blocks: DataFrame, width: int) -> np.ndarray:
    """A count-min sketch of all prefix digests: two rows of ``width`` cells that count up
    to two, in two bits each.  Tasks send the cells they touched, page by page; pages are
    merged in tasks, and the driver gets whole pages only (at most 2 * width / 4 bytes)."""
    def touched(cells: np.ndarray) -> pa.RecordBatch:
        cells, n = np.unique(cells, return_counts=True)
        pages, starts = np.unique(cells // PAGE, return_index=True)
        bounds = [*starts.tolist(), len(cells)]
        low, many = (cells % PAGE).astype("<u2"), n > 1
        cut = [(slice(x, y), many[x:y]) for x, y in zip(bounds, bounds[1:])]
        return pa.RecordBatch.from_arrays([pa.array(pages, pa.int32()), pa.array([low[s][~m].tobytes() for s, m in cut], pa.binary()),
                                           pa.array([low[s][m].tobytes() for s, m in cut], pa.binary())], ["page", "once", "more"])

    def count(batches):
        held, n = [], 0
        for batch in batches:
            k1, k2, _ = _flat(batch)
            held += [_cells(k1, width), _cells(k2, width) + width]
            n += 2 * len(k1)
            if n > 1 << 20:
                yield touched(np.concatenate(held))
                held, n = [], 0
        if n:
            yield touched(np.concatenate(held))

    def merge(batches):
        page, cells = None, None

        def packed() -> pa.RecordBatch:
            four = np.minimum(cells, 2).reshape(-1, 4)
            data = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([data], pa.binary())], ["page", "data"])

        for batch in batches:
            for p, once, more in zip(*(c.to_pylist() for c in batch.columns)):
                if p != page:
                    if page is not None:
                        yield packed()
                    page, cells = p, np.zeros(PAGE, np.uint8)
                x = np.frombuffer(once, "<u2")
                cells[x] = np.minimum(cells[x] + 1, 2)
                cells[np.frombuffer(more, "<u2")] = 2
        if page is not None:
            yield packed()

    out = np.zeros(-(-2 * width // PAGE) * PAGE // 4, np.uint8)
    merged = (blocks.select("nodes").mapInArrow(count, "page int, once binary, more binary")
              .repartition("page").sortWithinPartitions("page").mapInArrow(merge, "page int, data binary"))
    for row in merged.toLocalIterator():
        out[row["page"] * PAGE // 4:(row["page"] + 1) * PAGE // 4] = np.frombuffer(row["data"], np.uint8)
    return out


def _screened(blocks: DataFrame, width: int) -> DataFrame:
    """``blocks`` with ``cut``: how many of a block's nodes stand before the first one that
    the sketch proves to have one member.  All nodes after the cut have one member."""
    sketch = blocks.sparkSession.sparkContext.broadcast(_sketch(blocks, width))

    def run(batches):
        cells = sketch.value

        def at(x):
            return cells[x >> 2] >> ((x & 3) << 1).astype(np.uint8) & 3

        for batch in batches:
            k1, k2, sizes = _flat(batch)
            cut = sizes.copy()
            if len(k1):
                alone = np.minimum(at(_cells(k1, width)), at(_cells(k2, width) + width)) == 1
                starts = np.cumsum(sizes) - sizes
                place = np.where(alone, np.arange(len(k1)) - np.repeat(starts, sizes), len(k1))
                full = sizes > 0
                cut[full] = np.minimum(np.minimum.reduceat(place, starts[full]), sizes[full])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut.astype(np.int32))], [*batch.schema.names, "cut"])

    schema = T.StructType([*blocks.schema.fields, T.StructField("cut", T.IntegerType())])
    out = stored(blocks.mapInArrow(run, schema), "trie-screened")
    sketch.unpersist()
    return out


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of (k1, k2, conv_id): neighbouring ids are joined first, and the
    pieces of one node are read in order by one task that holds a piece at a time."""
    pieces = (ends.groupBy("k1", "k2", F.shiftright("conv_id", IDS).alias("piece"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("k1", "k2", "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids")))

    def run(batches):
        key, sha, out = None, None, []
        for batch in batches:
            for k1, k2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["k1", "k2", "ends_sha256"])
                out = []
        if key is not None:
            out.append((*key, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["k1", "k2", "ends_sha256"])

    return (pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "piece")
            .mapInArrow(run, "k1 long, k2 long, ends_sha256 string"))


def trie(rows: DataFrame, heads: DataFrame | None = None, skipped: Callable[[int], int] = lambda conv_id: 0,
         most_cells: int = MOST_CELLS) -> DataFrame:
    """One row per node of the trie of the conversations ``rows`` (from ``turns``): conv_id
    (smallest member), depth, parent_conv_id (root: null), n_convs, n_children, n_leaves and
    saved_tokens of the subtree, ends_sha256.

    A conversation is read in the order of (turn, nulls first; then the digest of role and
    text, which decides between turns of one number).  ``heads`` (conv_id, turn, a, b, chars)
    come before its own turns, of which the first ``skipped(conv_id)`` are left out; one
    that keeps no turn is a member of the root alone.  Rows without a conv_id are left
    out, and heads of conversations that have no row of their own count as conversations.
    Null roles and texts are empty ones; repeated turns count as often as they
    stand.  Extra columns are not read.  An empty table has no node, not even a root.

    The sketch has four cells for each prefix, up to ``most_cells`` a row; with more
    prefixes than that, fewer tails are proven and more prefixes grouped: the result is the
    same.  A conversation of any length is read as a sorted stream."""
    spark = rows.sparkSession
    own = rows.select("conv_id", F.lit(True).alias("own"), "turn", "a", "b", "chars")
    if heads is not None:
        own = own.union(heads.select("conv_id", F.lit(False), "turn", "a", "b", "chars"))
    own = own.repartition("conv_id").sortWithinPartitions("conv_id", F.asc("own"), *_order())
    blocks = stored(_blocks(own, skipped), "trie-blocks")
    n = blocks.agg(F.sum(F.size("nodes"))).first()[0] or 0
    width = min(PAGE, most_cells)  # a power of two
    while width < min(4 * n, most_cells):
        width *= 2
    blocks = _screened(blocks, width)

    shared = F.slice("nodes", 1, F.col("cut"))
    members = blocks.where("cut > 0").select("conv_id", F.inline(shared))
    groups = stored(members.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("before").alias("before"),
        F.count(F.when(F.col("ends"), 1)).alias("n_ends")), "trie-groups")
    starts = stored(blocks.where("cut < size(nodes)").select("conv_id", F.get("nodes", F.col("cut")).alias("x"))
                    .select("conv_id", "x.depth", "x.p1", "x.p2", "x.before", "x.ends"), "trie-starts")

    # (conv_id, before, leaf): code points before the nodes that a conversation owns (their
    # number grows with the depth, so the least belongs to the first), and whether its last is a leaf
    owners = stored(
        groups.select("conv_id", "before", F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0).alias("leaf"))
        .union(starts.select("conv_id", "before", F.lit(1)))
        .union(blocks.where("last").select("conv_id", "upto", F.lit(0)))
        .groupBy("conv_id").agg(F.min("before").alias("upto"), F.max("leaf").alias("leaf")), "trie-owners")
    sums = (blocks.where("cut > 0").select("conv_id", F.transform(shared, lambda x: F.struct(x["k1"].alias("k1"), x["k2"].alias("k2"),
                                                                                         x["before"].alias("before"))).alias("at"))
            .join(owners, "conv_id").select("upto", "leaf", F.inline("at"))
            .groupBy("k1", "k2").agg(F.sum("leaf").alias("n_leaves"),
                                     F.sum(F.greatest(F.col("upto") - F.col("before"), F.lit(0))).alias("saved_tokens")))
    children = stored(groups.select("p1", "p2").union(starts.select("p1", "p2")).groupBy("p1", "p2")
                      .agg(F.count(F.lit(1)).alias("n_children")), "trie-children")

    # a node's parent: at most a thousand parents have a thousandth of all children each;
    # these and the root are sent to the children, the others are met by key
    whole = children.agg(F.sum("n_children")).first()[0] or 0
    top = owners.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("leaf").alias("n_leaves"),
                     F.sum("upto").alias("saved_tokens")).where("n_convs > 0")
    parents = groups.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    root = top.select(F.lit(ROOT[0]).cast("long").alias("p1"), F.lit(ROOT[1]).cast("long").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    wide = children.where(F.col("n_children") * 1000 >= whole).select("p1", "p2")
    known = F.broadcast(stored(parents.join(F.broadcast(wide), ["p1", "p2"]).union(root), "trie-wide"))

    ends = members.where("ends").select("k1", "k2", "conv_id").union(
        blocks.where("last and size(nodes) = 0").select(*(F.lit(x).cast("long") for x in ROOT), "conv_id"))
    digests = stored(_ends_digest(ends), "trie-ends")
    keys = ["k1", "k2"]
    fan = children.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children")
    nothing = F.sha2(F.lit(""), 256)
    inner = stored(groups.join(sums, keys, "left").join(fan, keys, "left").join(digests, keys, "left").select(
        "conv_id", "depth", "p1", "p2", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")), "trie-inner")

    def lone(conv_id, last):
        return [F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
                F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
                F.when(last, F.sha2(conv_id.cast("string"), 256)).otherwise(nothing).alias("ends_sha256")]

    hanging = inner.union(starts.select("conv_id", "depth", "p1", "p2", *lone(F.col("conv_id"), F.col("ends"))))
    out = ["conv_id", F.col("depth").cast("long").alias("depth"),
           # a parent that is no group has one member: the same conversation
           F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    sent = hanging.join(known, ["p1", "p2"]).select(*out)
    met = hanging.join(known, ["p1", "p2"], "left_anti").join(parents, ["p1", "p2"], "left").select(*out)
    tails = (blocks.where("cut + 1 < size(nodes)").select("conv_id", F.inline(F.expr("slice(nodes, cut + 2, size(nodes))")))
             .select("conv_id", F.col("depth").cast("long"), "conv_id", *lone(F.col("conv_id"), F.col("ends"))))
    of_root = digests.where((F.col("k1") == ROOT[0]) & (F.col("k2") == ROOT[1])).select("ends_sha256")
    fan_root = children.where((F.col("p1") == ROOT[0]) & (F.col("p2") == ROOT[1])).select("n_children")
    first = (top.join(F.broadcast(fan_root), how="left").join(F.broadcast(of_root), how="left")
             .select("conv_id", F.lit(0).cast("long"), F.lit(None).cast("long"), "n_convs",
                     F.coalesce("n_children", F.lit(0)).cast("long"), F.greatest("n_leaves", F.lit(1)).cast("long"), "saved_tokens",
                     F.coalesce("ends_sha256", nothing)))
    return sent.union(met).union(tails).union(first)


def branch_length(conv_id: int) -> int:
    """How many first turns a rebuilt conversation takes from the one it branches off."""
    return zlib.crc32(str(conv_id).encode()) % 6


def branches(rows: DataFrame, every: int = 100) -> DataFrame:
    """(conv_id, turn, a, b, chars): the first ``branch_length`` turns that each conversation
    takes from conversation ``conv_id - conv_id % every`` (all if it has fewer)."""
    first = (rows.where(F.col("conv_id") % every == 0)
             .withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order()))).where("at < 6"))
    first = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("long").alias("turn"), "a", "b", "chars"))).alias("first"))
    ids = rows.select("conv_id").distinct().withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int"))
    return (ids.where("h > 0").withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
            .join(first.select(F.col("conv_id").alias("base"), "first"), "base").select("conv_id", F.inline(F.slice("first", 1, F.col("h")))))


def branched_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations as they are rebuilt on the first turns of every hundredth."""
    rows = stored(turns(conversations), "trie-turns")
    return trie(rows, branches(rows), branch_length)


def branched_trie_sql(conversations: str = "conversations") -> str:
    """The same nodes as one DuckDB statement."""
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) AS v
    FROM range(256) t(i))),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM {conversations} WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                            lambda s, b: xor(s >> 8, crc[(xor(s, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM own), crc_table),
rebuilt AS (
  SELECT v.c, 0 AS own, pos, r, x FROM convs v JOIN own o ON o.c = v.c - v.c % 100 AND pos < h
  UNION ALL SELECT c, 1, pos, r, x FROM own JOIN convs USING (c) WHERE pos >= h),
ordered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, sha256(concat(length(r), ':', r, x)) AS t, length(x) AS l FROM rebuilt),
walk AS (
  SELECT c, 0::BIGINT AS d, '' AS k, NULL::VARCHAR AS pk, 0::BIGINT AS l FROM convs
  UNION ALL SELECT o.c, o.d, sha256(w.k || o.t), w.k, o.l FROM walk w JOIN ordered o ON o.c = w.c AND o.d = w.d + 1),
nodes AS (SELECT k, any_value(d) AS depth, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, any_value(l) AS l FROM walk GROUP BY k),
fan AS (SELECT pk AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY pk),
below AS (SELECT DISTINCT a.k AS top, b.k FROM walk a JOIN walk b ON a.c = b.c AND b.d >= a.d),
sums AS (
  SELECT top AS k, count(*) FILTER (fan.k IS NULL) AS n_leaves, sum((n_convs - 1) * l)::BIGINT AS saved_tokens
  FROM below b JOIN nodes n ON n.k = b.k LEFT JOIN fan ON fan.k = b.k GROUP BY top),
ends AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
  FROM walk w JOIN (SELECT c, max(d) AS d FROM walk GROUP BY c) USING (c, d) GROUP BY k)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.k = n.pk LEFT JOIN fan f ON f.k = n.k JOIN sums s ON s.k = n.k LEFT JOIN ends e ON e.k = n.k"""
