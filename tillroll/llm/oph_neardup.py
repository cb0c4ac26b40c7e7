"""MinHash near-dedup by one-permutation hashing with optimal densification.

One hash per shingle fills all slots: the hash's upper bits choose the slot, the
smallest hash in it is kept.  An empty slot copies the first filled one in its own
random order of slots, so that slots of small sets stay independent.  Rows of slots
are hashed into bands; texts that share a band bucket are joined to a few centres of
the bucket (stars); each star edge is confirmed on full shingle sets.  Members of a
bucket that the stars leave in different components meet in blocks: a pair goes on if
its sizes and the parities of its shingles' counts in classes, which bound the
difference of two sets from below, allow a link, and is confirmed like a star edge."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.shingles import mix, shingle_sets_of
from tillroll.llm.store import stored

BANDS, ROWS = 42, 6  # a pair of similarity 0.8 misses all bands with 3e-6
SLOTS = BANDS * ROWS
PARITIES = 2048  # classes of shingles of which a set's parities are kept
BLOCK = 512  # members of a bucket that meet as many others in one block


def _orders(slots: int) -> np.ndarray:
    """For each slot, the place of every other slot in its own random order."""
    rng = np.random.default_rng(20240229)
    return np.argsort(rng.random((slots, slots)), axis=1).astype(np.int16)


_ORDER = _orders(SLOTS)
_BAND = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature (SLOTS values) of sorted distinct hashes."""
    slot = ((shingles >> np.uint64(32)) * np.uint64(SLOTS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(slot, prepend=-1))
    filled, values = slot[first], shingles[first]
    out = np.empty(SLOTS, np.uint64)
    if len(filled) < SLOTS:
        empty = np.ones(SLOTS, bool)
        empty[filled] = False
        at = np.flatnonzero(empty)
        out[at] = values[_ORDER[np.ix_(at, filled)].argmin(axis=1)]
    out[filled] = values
    return out


def band_keys(shingles: np.ndarray) -> np.ndarray:
    rows = signature(shingles).reshape(BANDS, ROWS)
    h = _BAND.copy()
    for j in range(ROWS):
        h = mix(h ^ rows[:, j]) + rows[:, j]
    return mix(h).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, bands) of every document's whole text."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                n, digest, bands = [], [], []
                for s in shingle_sets_of(b.column(1).to_pylist(), words):
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    bands.append(band_keys(s) if len(s) else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), _lists(bands)],
                    ["doc_id", "n_shingles", "set_hash", "bands"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, bands array<long>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles) with the sorted distinct shingle hashes of each text."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), _lists(shingle_sets_of(b.column(1).to_pylist(), words))],
                    ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose full sets overlap enough."""
    both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return (both.withColumn("common", F.size(F.array_intersect("sa", "sb")))
            .where(F.col("common").cast("long") * 100 >= union.cast("long") * percent).select("a", "b").distinct())


def parities(shingles: np.ndarray) -> bytes:
    """One bit a class of shingles: whether it holds an odd number of them.  Two sets
    differ in at least as many shingles as their bits differ in."""
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _with_parities(sets: DataFrame) -> DataFrame:
    """(doc_id, bits) of stored shingle sets."""
    def run(batches):
        for b in batches:
            bits = [parities(x.values.to_numpy(zero_copy_only=False).view(np.uint64)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits, pa.binary())], ["doc_id", "bits"])

    return sets.select("doc_id", "shingles").mapInArrow(run, "doc_id long, bits binary")


def _block_pairs(blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of one block of (key, i, j, side, b, nb, root, bits) that sizes,
    components and parities don't rule out.  Rows of side 0 meet those of side 1, those
    of side 2 each other; blocks are sorted and lie in one task each."""
    names = ["key", "i", "j"]

    def met(block: pa.Table):
        side, ids, n, root = (block.column(x).to_numpy() for x in ("side", "b", "nb", "root"))
        bits = np.frombuffer(b"".join(block.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        for x in left:
            m, both = n[right], n[right] + n[x]
            y = right[(root[right] != root[x]) & (np.minimum(m, n[x]) * 100 >= np.maximum(m, n[x]) * percent)
                      & ((side[right] != 2) | (ids[right] > ids[x]))]
            if len(y):
                apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
                y = y[apart * (100 + percent) <= (n[y] + n[x]) * (100 - percent)]
                yield np.minimum(ids[y], ids[x]), np.maximum(ids[y], ids[x])

    def found(block: pa.Table) -> pa.RecordBatch:
        pairs = list(met(block))
        a, b = (np.concatenate([p[k] for p in pairs] or [np.empty(0, np.int64)]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        held, now = [], None
        for batch in batches:
            at = np.stack([batch.column(batch.schema.get_field_index(x)).to_numpy().astype(np.int64) for x in names], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
            for start, end in zip(cuts, cuts[1:]):
                if start < end:
                    if held and tuple(at[start]) != now:
                        yield found(pa.Table.from_batches(held))
                        held = []
                    now = tuple(at[start])
                    held.append(batch.slice(start, end - start))
        if held:
            yield found(pa.Table.from_batches(held))

    return blocks.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long")


def _left_pairs(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b) still to be confirmed of ``members`` (b, nb, key), each pair of which is to be
    looked at that lies in one bucket and in different components.  The members of a
    bucket's largest component meet the others only, the others also each other, in
    blocks of about ``size`` of either side."""
    rooted = stored(members.join(roots.select(F.col("id").alias("b"), "root"), "b", "left")
                    .withColumn("root", F.coalesce("root", "b")), "oph-members")
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    whole = (parts.groupBy("key").agg(F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most"))
             .where("all > most.n")
             .select("key", F.col("most.root").alias("main"), F.ceil(F.col("most.n") / size).cast("int").alias("mains"),
                     F.ceil((F.col("all") - F.col("most.n")) / size).cast("int").alias("others")))
    dealt = rooted.join(whole, "key").withColumn("is_main", F.col("root") == F.col("main"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("b"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))

    def upto(n: str):
        return F.sequence(F.lit(0), F.col(n) - 1)

    # a block of others meets the main blocks (j < 0) and, i <= j, every block of others
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).cast("int").alias("side"))
    own = F.col("own")
    others = F.concat(F.transform(upto("mains"), lambda k: place(own, -1 - k, 0)),
                      F.transform(upto("others"), lambda k: F.struct(
                          F.least(own, k).alias("i"), F.greatest(own, k).alias("j"),
                          F.when(own < k, 0).when(own > k, 1).otherwise(2).alias("side"))))
    mains = F.transform(upto("others"), lambda k: place(k, -1 - own, 1))
    blocks = (dealt.withColumn("x", F.explode(F.when(F.col("is_main"), mains).otherwise(others)))
              .select("key", "x.*", "b", "nb", "root"))
    bits = stored(_with_parities(sets.join(dealt.select(F.col("b").alias("doc_id")).distinct(), "doc_id", "left_semi")), "oph-parities")
    return _block_pairs(blocks.join(bits.select(F.col("doc_id").alias("b"), "bits"), "b"), percent).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if ``100 * |A and B| >= percent * |A or B|`` for their sets of
    distinct ``words``-word shingles (A-Z lower-cased).  A text of fewer words is one
    shingle; a null, empty or blank text has none and links with nothing.  Equal sets
    are one class before any pair is made, so copies cost no pairs.  Rows without an id
    link with nothing and are kept (component null); rows that repeat an id share its
    component.  Other columns are not read; an empty table gives an empty one.

    Every bucket gives four stars: around its smallest document and around three
    others, chosen by an order of their own in each bucket.  The last two are confirmed
    only where the first two left documents of a bucket in different components.  Where
    all four leave some, every pair of them is looked at."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = stored(signatures(docs, words), "oph-signatures")
    named = sig.where("n_shingles > 0 and doc_id is not null")
    classes = stored(named.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("rep")), "oph-classes")
    rows = (named.join(classes.select("set_hash", F.col("rep").alias("doc_id")), ["set_hash", "doc_id"])
            .select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.explode("bands").alias("key"))
            .repartition("key"))
    # b XOR a number of the bucket's own: its minimum is another member in each bucket
    turned = [F.col("b")] + [F.col("b").bitwiseXOR(F.xxhash64("key", F.lit(k))) for k in (1, 2, 3)]
    centres = rows.groupBy("key").agg(F.max("b").alias("top"), *[F.min_by("b", t).alias(f"c{k}") for k, t in enumerate(turned)],
                                      *[F.min_by("nb", t).alias(f"n{k}") for k, t in enumerate(turned)]).where("top > c0").drop("top")
    joined = rows.join(centres, "key")
    star = [x for x in joined.columns if x != "key"]
    # a centre's pairs are all star edges: only the other members' buckets go on
    met = stored(joined.groupBy(*star).agg(F.collect_list(F.when(~F.col("b").isin(*[F.col(f"c{k}") for k in range(4)]), F.col("key")))
                                           .alias("keys")), "oph-stars")

    def edges(*centre: int) -> DataFrame:
        """Distinct star edges, without those whose sizes alone rule a link out."""
        rays = met.select("b", "nb", F.explode(F.array(*[F.struct(F.col(f"c{k}").alias("c"), F.col(f"n{k}").alias("nc"))
                                                         for k in centre])).alias("x")).select("b", "nb", "x.*")
        possible = F.least("nb", "nc") * 100 >= F.greatest("nb", "nc") * percent
        return (rays.where((F.col("b") != F.col("c")) & possible)
                .select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct())

    ids = stored(met.select(F.col("b").alias("doc_id")).distinct(), "oph-ids")
    sets = stored(shingle_sets(docs.join(ids, "doc_id", "left_semi"), words), "oph-sets")
    first = components(_confirmed(stored(edges(0, 1), "oph-pairs"), sets, percent), "oph")
    apart = (edges(2, 3).join(first.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a", "left")
             .join(first.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b", "left")
             .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
    second = _confirmed(stored(apart, "oph-pairs"), sets, percent)
    links = first.select(F.col("id").alias("a"), F.col("root").alias("b")).union(second)
    starred = components(links, "oph")
    members = met.select("b", "nb", F.explode("keys").alias("key"))
    third = _confirmed(stored(_left_pairs(members, starred, sets, percent, BLOCK), "oph-pairs"), sets, percent)
    roots = components(starred.select(F.col("id").alias("a"), F.col("root").alias("b")).union(third), "oph")
    rooted = (classes.join(roots, classes.rep == roots.id, "left")
              .select("set_hash", F.coalesce("root", "rep").alias("component_id")))
    out = sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash"))
    return (out.join(rooted, "set_hash", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def near_duplicates_sql(words: int, percent: int = 80, table: str = "documents") -> str:
    """The same rows as one DuckDB statement that joins all texts on their shingles (ids
    unique), for small tables."""
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([{run} FOR i IN range(1, len(w) - {words - 1} + 1)]) END AS s FROM split),
rows AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n + b.n) AS both_sizes, count(*) AS shared
  FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * shared >= {percent} * (both_sizes - shared)),
reached(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS low FROM reached GROUP BY x)
SELECT d.doc_id, len(s)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM sets d LEFT JOIN lowest l ON l.x = d.doc_id"""
