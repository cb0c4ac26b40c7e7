"""Sharding along a Hilbert curve over several metadata columns (DataFrame only).

Each column is quantised by its own quantile cuts, the cell's place on the curve is
looked up, and the curve is cut into runs of equal row counts.  Rows of neighbouring
cells share a shard, so a filter on any of the columns prunes files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.store import shuffle_width, stored


def order_code(col: Column, kind: T.DataType) -> Column:
    """A long that sorts as the column does: numbers as they are (fractions cut),
    texts by their first seven bytes."""
    if isinstance(kind, T.NumericType):
        return col.cast("double").cast("long") if isinstance(kind, (T.FloatType, T.DoubleType)) else col.cast("long")
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.unix_micros(col.cast("timestamp"))
    return F.conv(F.rpad(F.hex(F.substring(col.cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def curve(spark: SparkSession, dims: int, bits: int) -> DataFrame:
    """(cell, place): every cell of a ``dims``-dimensional grid of ``2**bits`` steps (its
    coordinates' bits one after the other) and its place on the Hilbert curve.  The
    table has ``2**(dims*bits)`` rows whatever the data."""
    x = [f"x{d}" for d in range(dims)]
    low = (1 << bits) - 1
    cells = spark.range(1 << (dims * bits)).select(
        F.col("id").alias("cell"),
        *[F.shiftright("id", bits * (dims - 1 - d)).bitwiseAND(F.lit(low)).alias(x[d]) for d in range(dims)])
    step = 1 << (bits - 1)
    while step > 1:  # undo the turns of all levels but the first, coarse to fine
        for d in range(dims):
            on = F.col(x[d]).bitwiseAND(F.lit(step)) != 0
            swap = F.col("x0").bitwiseXOR(F.col(x[d])).bitwiseAND(F.lit(step - 1))
            cells = cells.withColumns(
                {"x0": F.when(on, F.col("x0").bitwiseXOR(F.lit(step - 1))).otherwise(F.col("x0").bitwiseXOR(swap))}
                | ({x[d]: F.when(on, F.col(x[d])).otherwise(F.col(x[d]).bitwiseXOR(swap))} if d else {}))
        step >>= 1
    for d in range(1, dims):  # Gray code across the axes
        cells = cells.withColumn(x[d], F.col(x[d]).bitwiseXOR(F.col(x[d - 1])))
    flip = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        flip = flip.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << level)) != 0,
                                      F.lit((1 << level) - 1)).otherwise(F.lit(0)))
    cells = cells.withColumn("flip", flip)
    place = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            bit = F.shiftright(F.col(x[d]).bitwiseXOR(F.col("flip")), level).bitwiseAND(F.lit(1))
            place = F.shiftleft(place, 1).bitwiseOR(bit)
    return cells.select("cell", place.alias("place"))


def quantised(df: DataFrame, columns: list[str], bits: int) -> Column:
    """The grid cell of a row: per column the number of quantile cuts below it (nulls
    count as lowest).  The cuts are ``2**bits - 1`` numbers per column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    codes = [order_code(F.col(c), kinds[c]) for c in columns]
    at = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(c, at, 1000).alias(f"c{k}") for k, c in enumerate(codes)]).first()
    cell = F.lit(0).cast("long")
    for k, code in enumerate(codes):
        steps = sum([F.when(code > cut, 1).otherwise(0) for cut in cuts[k] or []], F.lit(0)).cast("long")
        cell = F.shiftleft(cell, bits).bitwiseOR(steps)
    return cell


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0) in the order of ``key``, ties by hash bucket and
    ``order``.  ``key`` has a bounded number of values; a value that holds many rows
    is spread over as many buckets as the session has shuffle partitions."""
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(shuffle_width(rows.sparkSession))))
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)  # one row a cell
    base = counts.groupBy(key).agg(F.sum("_n").alias("_m")) \
        .select(key, F.coalesce(F.sum("_m").over(whole), F.lit(0)).alias("_base"))
    first = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n").join(base, key)
    within = Window.partitionBy(key, "_bucket").orderBy(*order)
    return (dealt.withColumn("rank", F.row_number().over(within) - 1)
            .join(first, [key, "_bucket"])
            .withColumn("rank", F.col("rank") + F.col("_first") + F.col("_base"))
            .drop("_bucket", "_first", "_base"))


def shards(docs: DataFrame, columns: list[str], n_shards: int = 16, bits: int = 4,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, place (on the curve), law, shard, slot, grown_shard.

    Law ``rows``: shard counts are at most one apart; slots are gapless from 0 in curve
    order.  Null metadata counts as lowest, null text has size 1 and CRC 0, rows
    without an id or repeated rows each get a slot; an empty table gives an empty one.
    The text is read once for size and CRC and is not shuffled."""
    if len(columns) * bits > 16:
        raise ValueError("the curve's table is broadcast: at most 16 bits in all")
    cell = quantised(docs, columns, bits)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
                       F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                       cell.alias("cell"))
    rows = stored(rows.join(F.broadcast(curve(docs.sparkSession, len(columns), bits)), "cell").drop("cell"), "hilbert")
    per, more = divmod(rows.count(), n_shards)
    cut = more * (per + 1)  # the first ``more`` shards have one row more
    rank = F.col("rank")
    late = rank - F.lit(cut)
    shard = F.when(rank < cut, F.expr(f"rank div {per + 1}"))
    slot = F.when(rank < cut, rank % F.lit(per + 1))
    if per:
        shard, slot = shard.otherwise(F.lit(more) + F.expr(f"(rank - {cut}) div {per}")), slot.otherwise(late % F.lit(per))
    return ranked(rows, "place", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "place", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, files_per_shard: int = 1, id_col: str = "doc_id") -> None:
    """Write ``docs`` as Parquet folders shard=0.., rows in slot order (ids unique)."""
    keys = placed.select(F.col("doc_id").alias(id_col), "shard", "slot")
    rows = docs.join(keys, id_col)
    (rows.repartitionByRange(max(1, files_per_shard) * shuffle_width(docs.sparkSession), "shard", "slot")
     .sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path))
