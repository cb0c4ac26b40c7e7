"""Embedding near-duplicates by product quantisation.

Coarse inverted lists hold residual subspace codes.  A vector is compared with a
list's codes through lookup tables of its own subspace products (asymmetric
distances); what may still reach the limit, given each code's stored error, gets
its exact cosine in double precision.  Lists and codebooks are fitted on a bounded
sample; every vector is indexed and every vector is a query.

Equal vectors are one class.  Lists are cut into blocks of bounded size by hash, and
a task gets a block of queries with a block of a list, so neither a long list nor a
group of near copies lands in one task.  A block pair returns a row per linked
vector: its links there and its local component's name, never the pairs."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.components import components
from tillroll.llm.store import stored


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    sample: int = 16_384      # vectors that lists and codebooks are fitted on, at most
    most_lists: int = 4_096
    subspaces: int = 8
    codes: int = 256
    rounds: int = 8
    #: A link's offset, seen along one direction, is taken as up to so many standard
    #: deviations of an evenly spread one; ``dims ** 0.5`` makes the probes exhaustive.
    sigmas: float = 4.0
    block: int = 256


def _kmeans(x: np.ndarray, k: int, rounds: int, rng, unit: bool) -> np.ndarray:
    c = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        half = 0.0 if unit else 0.5 * (c * c).sum(1)
        at = np.concatenate([(x[i:i + 4096] @ c.T - half).argmax(1) for i in range(0, len(x), 4096)])
        n = np.bincount(at, minlength=k)
        order = np.argsort(at, kind="stable")
        sums = np.add.reduceat(x[order], np.r_[0, np.cumsum(n[n > 0])[:-1]], axis=0)
        c[n > 0] = sums / n[n > 0, None]
        if unit:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class Index:
    """Fitted lists and codebooks; its size depends on the settings only."""
    centres: np.ndarray
    books: list[np.ndarray]
    cuts: list[int]
    radius: float

    @classmethod
    def fit(cls, unit: np.ndarray, n_lists: int, s: Settings) -> Index:
        rng = np.random.default_rng(7)
        unit = unit.astype(np.float32)
        dims = unit.shape[1]
        centres = _kmeans(unit, min(n_lists, len(unit)), s.rounds, rng, True)
        rest = unit - centres[(unit @ centres.T).argmax(1)]
        parts = min(s.subspaces, dims)
        cuts = [dims * k // parts for k in range(parts + 1)]
        books = [_kmeans(rest[:, a:b], min(s.codes, len(rest)), s.rounds, rng, False) for a, b in zip(cuts, cuts[1:])]
        reach = (2 - 2 * s.cosine) ** 0.5
        return cls(centres, books, cuts, reach * min(1.0, s.sigmas / dims ** 0.5))

    def place(self, unit: np.ndarray):
        """Home list, codes, code error and probed lists of unit vectors (float32)."""
        score = unit @ self.centres.T
        home = score.argmax(1)
        rest = unit - self.centres[home]
        codes = np.empty((len(unit), len(self.books)), np.uint8)
        for m, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            part = rest[:, a:b]
            codes[:, m] = (part @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
            rest[:, a:b] -= book[codes[:, m]]
        error = np.linalg.norm(rest, axis=1)
        # a link of a query lies at most ``radius`` along the line between two centres,
        # so a list counts if the plane between it and the home list is that near
        apart = np.linalg.norm(self.centres[:, None] - self.centres[None], axis=2) if len(self.centres) <= 512 else None
        probes = []
        for k in range(len(unit)):
            gap = score[k, home[k]] - score[k]
            far = apart[home[k]] if apart is not None else np.linalg.norm(self.centres - self.centres[home[k]], axis=1)
            probes.append(np.flatnonzero(gap <= self.radius * far + 1e-6).astype(np.int32))
        return home, codes, error, probes

    def near(self, queries: np.ndarray, listed: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric products of unit queries with the coded vectors of a list."""
        out = np.repeat((queries @ self.centres[listed])[:, None], len(codes), axis=1)
        for m, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            out += (queries[:, a:b] @ book.T)[:, codes[:, m]]
        return out


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component in a small graph of pairs (a, b)."""
    low = np.arange(n)
    while True:
        now = low.copy()
        np.minimum.at(now, a, low[b])
        np.minimum.at(now, b, low[a])
        now = now[now]
        if (now == low).all():
            return low
        low = now


def _classes(vectors: DataFrame, dims_of: str, kind: str) -> DataFrame:
    """(vec_id, c, vec): c is a hash of the vector, null if it can't be compared."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                lists, ids = b.column(1), b.column(0)
                c, out = [], []
                for k in range(b.num_rows):
                    v = lists[k].as_py()
                    x = None if not v or any(e is None for e in v) else np.array(v, kind)
                    if x is None or not np.isfinite(x).all() or not x.any() or ids[k].as_py() is None:
                        c.append(None)
                        out.append(None)
                    else:
                        raw = x.tobytes()
                        c.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True))
                        out.append(raw)
                yield pa.RecordBatch.from_arrays([ids, pa.array(c, pa.int64()), pa.array(out, pa.binary())],
                                                 ["vec_id", "c", "vec"])

    return vectors.mapInArrow(run, f"{dims_of}, c long, vec binary")


def _unit(raw: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x, x.astype(np.float32)


def near_duplicates(vectors: DataFrame, settings: Settings = Settings(),
                    id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Rows are linked if their cosine (double precision) is at least ``settings.cosine``.
    Vectors that are null, empty, zero, hold null or non-finite components, or have
    another length than most, link with nothing; so do rows without an id (component
    null, kept).  Rows that repeat a vector are links of each other.  Other columns are
    not read; an empty table gives an empty one."""
    s = settings
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast(f"array<{'float' if kind == '<f4' else 'double'}>").alias("v"))
    rows = stored(_classes(rows, "vec_id long", kind), "pq-vectors")
    length = (rows.where("c is not null").groupBy(F.octet_length("vec").alias("bytes"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("bytes")).first())
    fits = F.octet_length("vec") == F.lit(length["bytes"] if length else 0)
    known = rows.where("c is not null").where(fits)
    copies = stored(known.groupBy("c").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "pq-classes")
    classes = stored(known.join(copies.withColumnRenamed("rep", "vec_id"), ["c", "vec_id"])
                     .dropDuplicates(["c"]).select("c", "copies", "vec"), "pq-distinct")
    total = classes.count()
    sample = [bytes(r["vec"]) for r in classes.orderBy(F.xxhash64("c")).select("vec").limit(s.sample).collect()]
    none = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not sample:
        return none.withColumn("kept", F.lit(True))
    n_lists = min(s.most_lists, max(1, len(sample) // 8), 1 << (max(1, int(total ** 0.5)) - 1).bit_length())
    index = spark.sparkContext.broadcast(Index.fit(_unit(sample, kind)[0], n_lists, s))

    def encode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                home, codes, error, probes = index.value.place(_unit(b.column(2).to_pylist(), kind)[1])
                ends = np.cumsum([0] + [len(p) for p in probes]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(home.astype(np.int32)), pa.array([x.tobytes() for x in codes], pa.binary()),
                     pa.array(error.astype(np.float32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(probes)))],
                    [*b.schema.names, "home", "codes", "error", "probes"])

    coded = stored(classes.mapInArrow(encode, "c long, copies long, vec binary, home int, codes binary, error float, "
                                              "probes array<int>"), "pq-codes")
    # block counts: one row per list, so a table of bounded size
    asked = coded.select("c", "copies", "vec", "home", F.explode("probes").alias("list"))
    width = (coded.groupBy(F.col("home").alias("list")).agg(F.count(F.lit(1)).alias("np")).join(
        asked.groupBy("list").agg(F.count(F.lit(1)).alias("nq")), "list", "left")
        .select("list", F.ceil(F.col("np") / s.block).alias("np"), F.ceil(F.col("nq") / s.block).alias("nq")))
    width = stored(width, "pq-lists")
    posted = (coded.withColumnRenamed("home", "list").join(F.broadcast(width), "list")
              .groupBy("list", F.pmod(F.xxhash64("c"), F.col("np")).alias("block"))
              .agg(F.collect_list(F.struct("c", "copies", "vec", "codes", "error", "probes")).alias("posted")))
    queried = (asked.join(F.broadcast(width), "list")
               .groupBy("list", F.pmod(F.xxhash64("c"), F.col("nq")).alias("block"))
               .agg(F.collect_list(F.struct("c", "copies", "vec", "home")).alias("asked")))
    pairs = queried.select("list", "asked").join(posted.select("list", "posted"), "list")

    def compare(batches):
        i = index.value
        for batch in batches:
            out_c, out_n, out_r = [], [], []
            for k in range(batch.num_rows):
                listed = batch.column(0)[k].as_py()
                q, p = (pa.array(batch.column(j)[k].values) for j in (1, 2))
                qc, pc = (x.field("c").to_numpy() for x in (q, p))
                qx, q32 = _unit(q.field("vec").to_pylist(), kind)
                px, _ = _unit(p.field("vec").to_pylist(), kind)
                codes = np.frombuffer(b"".join(p.field("codes").to_pylist()), np.uint8).reshape(len(pc), -1)
                bound = i.near(q32, listed, codes) + p.field("error").to_numpy()[None]
                a, b = np.nonzero((bound >= s.cosine - 1e-4) & (qc[:, None] != pc[None]))
                sure = np.concatenate([np.einsum("ij,ij->i", qx[a[z:z + 65536]], px[b[z:z + 65536]])
                                       for z in range(0, max(1, len(a)), 65536)]) >= s.cosine
                a, b = a[sure], b[sure]
                if not len(a):
                    continue
                # the same pair is met from the other side if that vector probes this
                # one's list; then each side counts its own
                n_lists = len(i.centres)
                probes = p.field("probes")
                own = np.repeat(np.arange(len(pc)), np.diff(probes.offsets.to_numpy()))
                probed = own * n_lists + probes.flatten().to_numpy()
                once = ~np.isin(b * n_lists + q.field("home").to_numpy()[a], probed)
                qn, pn = q.field("copies").to_numpy(), p.field("copies").to_numpy()
                c = np.concatenate([qc[a], pc[b]])
                n = np.concatenate([pn[b], np.where(once, qn[a], 0)])
                nodes, at = np.unique(c, return_inverse=True)
                links = np.bincount(at, n, len(nodes)).astype(np.int64)
                out_c.append(nodes)
                out_n.append(links)
                out_r.append(nodes[_roots(at[:len(a)], at[len(a):], len(nodes))])
            if out_c:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_c, out_n, out_r)],
                                                 ["c", "n", "root"])

    found = stored(pairs.mapInArrow(compare, "c long, n long, root long"), "pq-links")
    groups = components(found.select(F.col("c").alias("a"), F.col("root").alias("b")), "pq")
    # component names are hashes so far: the smallest vector id of each is its name
    grouped = (copies.join(groups, copies.c == groups.id, "left")
               .select("c", "rep", "copies", F.coalesce("root", "c").alias("root")))
    named = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    links = found.groupBy("c").agg(F.sum("n").alias("n"))
    final = stored(grouped.join(named, "root").join(links, "c", "left")
                   .select("c", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "pq-final")
    out = rows.select("vec_id", F.when(fits, F.col("c")).alias("c")).join(final, "c", "left")
    return (out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def near_duplicates_sql(cosine: float = 0.95, table: str = "embeddings") -> str:
    """The same rows as one DuckDB statement over all pairs (ids unique), for small tables."""
    return f"""
WITH RECURSIVE given AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM {table}),
sound AS (
  SELECT *, sqrt(list_sum([x * x FOR x IN e])) AS norm FROM given
  WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0),
usable AS (
  SELECT * FROM sound WHERE norm > 0
  AND len(e) = (SELECT len(e) FROM sound WHERE norm > 0 GROUP BY len(e) ORDER BY count(*) DESC, len(e) DESC LIMIT 1)),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / a.norm / b.norm >= {cosine}),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS low FROM reached GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT g.vec_id, coalesce(n, 0) AS n_links, least(g.vec_id, coalesce(low, g.vec_id)) AS component_id,
  g.vec_id = least(g.vec_id, coalesce(low, g.vec_id)) AS kept
FROM given g LEFT JOIN lowest l ON l.x = g.vec_id LEFT JOIN counted c ON c.x = g.vec_id"""
