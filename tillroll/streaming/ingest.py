"""Incremental ingest: new period files → bronze, with Structured Streaming.

The batch ingest (``sources.periods``) is stateless per row — typing, the
provenance literal and the overlap cut (a filter on the earlier period) — so
the same plan runs unchanged on a file stream.  Each period folder is one
stream; the union is appended to the bronze Parquet folder, and the
checkpoint (in shared storage) makes a restart resume where it stopped.
``availableNow`` processes what is there and stops, like a scheduled batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas as S
from tillroll.sources.periods import type_period


def period_stream(spark: SparkSession, folder: str, label: str, fmt: str = "csv",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.RAW_TEXT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        raw = reader.option("header", True).option("mode", "FAILFAST").csv(folder)
    else:
        raw = reader.format(fmt).load(folder)
    return type_period(raw, label)


def ingest_stream(spark: SparkSession, early_folder: str, late_folder: str, early_label: str,
                  late_label: str, cutoff: str, fmt: str = "csv") -> DataFrame:
    """The streaming counterpart of ``periods.ingest`` (same columns, same rows)."""
    cut = F.lit(cutoff).cast("timestamp_ntz")
    early = period_stream(spark, early_folder, early_label, fmt).filter(F.col(S.INVOICE_DATE) < cut)
    late = period_stream(spark, late_folder, late_label, fmt)
    return early.unionByName(late)


def start_bronze_append(stream: DataFrame, bronze_folder: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", bronze_folder).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
