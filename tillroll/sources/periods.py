"""Period scans, typing and consolidation (bronze).

S1  read one period file (CSV with header or Parquet), schema given
P1  text columns → string
P2  customer id: lenient (unparseable → null)
P3  quantity / price: strict (unparseable or beyond the type → the job fails)
P4  invoice date: strict timestamp without time zone
P5  provenance literal per input
P6  overlap cut: the earlier period keeps dates before the cut
P7  union of the two (no row index)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas as S


def read_period(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One period as it arrives.  CSV is read as text with a fixed schema."""
    if fmt == "csv":
        return (spark.read.schema(S.RAW_TEXT_SCHEMA).option("header", True)
                .option("mode", "FAILFAST").csv(path))
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported period format: {fmt}")


def _is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def lenient_id(col: Column, dtype: T.DataType) -> Column:
    """A whole number or null; text like '13085.0' is accepted, junk is null."""
    if _is_integral(dtype):
        return col.cast("bigint")
    as_dec = F.trim(col.cast("string")).try_cast("decimal(38,6)")
    return F.when(as_dec == F.floor(as_dec), as_dec.cast("bigint"))


def strict(col: Column, kind: str, what: str, same: str | None = None) -> Column:
    """A cast that stops the job on a value it can't represent, whether ANSI mode
    is on or not.  ``same``: a wider type in which value and result must agree."""
    out = col.try_cast(kind)
    lost = out.isNull() if same is None else out.isNull() | (out.cast(same) != col.try_cast(same))
    message = F.concat(F.lit(f"{what} can't be read: "), col.cast("string"))
    return F.when(col.isNotNull() & F.coalesce(lost, F.lit(True)), F.raise_error(message).cast(kind)).otherwise(out)


def strict_quantity(col: Column, dtype: T.DataType) -> Column:
    if _is_integral(dtype):
        return col.cast("bigint")
    return strict(strict(col, "decimal(38,6)", S.QUANTITY), "bigint", S.QUANTITY, same="decimal(38,6)")


def strict_price(col: Column, dtype: T.DataType) -> Column:
    """Prices have four decimals; one with more stops the job instead of being rounded."""
    if isinstance(dtype, T.DecimalType) and dtype.scale <= 4 and dtype.precision - dtype.scale <= 14:
        return col.cast(S.PRICE_TYPE)
    return strict(col, S.PRICE_TYPE, S.PRICE, same="decimal(38,12)")


def type_period(df: DataFrame, period_label: str) -> DataFrame:
    """P1–P5 on one raw period."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        F.col(S.INVOICE).cast("string").alias(S.INVOICE),
        F.col(S.STOCK_CODE).cast("string").alias(S.STOCK_CODE),
        F.col(S.DESCRIPTION).cast("string").alias(S.DESCRIPTION),
        strict_quantity(F.col(S.QUANTITY), types[S.QUANTITY]).alias(S.QUANTITY),
        (F.col(S.INVOICE_DATE) if isinstance(types[S.INVOICE_DATE], T.TimestampNTZType)
         else strict(F.col(S.INVOICE_DATE), "timestamp_ntz", S.INVOICE_DATE)).alias(S.INVOICE_DATE),
        strict_price(F.col(S.PRICE), types[S.PRICE]).alias(S.PRICE),
        lenient_id(F.col(S.CUSTOMER), types[S.CUSTOMER]).alias(S.CUSTOMER),
        F.col(S.COUNTRY).cast("string").alias(S.COUNTRY),
        F.lit(period_label).alias(S.PERIOD),
    )


def consolidate(early: DataFrame, late: DataFrame, cutoff: str) -> DataFrame:
    """P6 + P7: the overlap is kept from the later period only."""
    cut = F.lit(cutoff).cast("timestamp_ntz")
    return early.filter(F.col(S.INVOICE_DATE) < cut).unionByName(late)


def ingest(early_raw: DataFrame, late_raw: DataFrame, early_label: str, late_label: str,
           cutoff: str) -> DataFrame:
    """Two raw periods → consolidated, typed bronze lines."""
    return consolidate(type_period(early_raw, early_label), type_period(late_raw, late_label), cutoff)


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """Row count, column count and date range of the consolidated lines."""
    return bronze.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(bronze.columns)).cast("bigint").alias("column_count"),
        F.min(S.INVOICE_DATE).alias("first_invoice_date"),
        F.max(S.INVOICE_DATE).alias("last_invoice_date"),
    )
