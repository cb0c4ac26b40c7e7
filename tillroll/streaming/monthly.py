"""Monthly totals kept up to date, batch by batch.

The state is one row per order with measures that merge (least time, sums, flags), in a
folder a month, and the totals of each month.  A batch of new lines is reduced to its
orders; these are merged with what the state has of the same invoices, and only the
months that an order of the batch is in, was in or moves to are written anew.  A manifest
names each month's folder and the last batch.  It is replaced in one step once all is
written, so a reader sees whole batches only, and a batch that comes again after a
failure is passed over."""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas as S
from tillroll.plans import layers
from tillroll.plans.sales import monthly_totals
from tillroll.session import delete_folder, list_folders, materialize, read_pointer, write_pointer

#: measure → how an order's rows are merged
_MERGE = {"order_datetime": F.min, "customer_id": F.max, "gross_product_sales_value": F.sum, "product_cancellation_value": F.sum,
          "net_product_sales_value": F.sum, "has_product_sale": F.bool_or, "has_product_cancellation": F.bool_or}
_MONEY = [c for c in _MERGE if c.endswith("_value")]


def _merged(orders: DataFrame) -> DataFrame:
    out = orders.groupBy(S.INVOICE).agg(*[merge(c).alias(c) for c, merge in _MERGE.items()])
    return out.withColumns({c: F.col(c).cast("decimal(38,4)") for c in _MONEY})


def _orders_of(lines: DataFrame) -> DataFrame:
    """The orders of some lines (from ``layers.fact_order_lines``), reduced where they lie."""
    return _merged(lines.select(
        S.INVOICE, F.col(S.INVOICE_DATE).alias("order_datetime"), F.col(S.CUSTOMER).alias("customer_id"), *_MONEY,
        F.col("is_product_sale").alias("has_product_sale"), F.col("is_product_cancellation").alias("has_product_cancellation")))


class MonthlyTotals:
    """The state under ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str, categories: DataFrame):
        self.spark, self.folder, self.categories = spark, folder, categories
        self._pointer = os.path.join(folder, "manifest")

    def manifest(self) -> dict:
        text = read_pointer(self.spark, self._pointer)
        return json.loads(text) if text else {"batch": -1, "months": {}}

    def _read(self, kind: str, months: dict, names=None) -> DataFrame | None:
        """The stored rows of some months (all), each with its ``month``."""
        wanted = sorted(months if names is None else set(names) & set(months))
        folders = [os.path.join(self.folder, f"{kind}-{months[m]}", f"_month={m}") for m in wanted]
        return self.spark.read.parquet(*folders) if folders else None

    def apply(self, lines: DataFrame, batch: int) -> list[str]:
        """Add the bronze ``lines`` of a batch (numbered from 0, in order); the months
        that were written.  A batch that was applied before changes nothing."""
        now = self.manifest()
        if batch <= now["batch"]:
            return []
        flagged = layers.flagged(lines.withColumn("_repeats", F.lit(1).cast("bigint")), self.categories)
        new = materialize(_orders_of(layers.fact_order_lines(flagged)))
        stored = self._read("orders", now["months"])
        same = F.col(S.INVOICE).eqNullSafe(F.col("_invoice"))
        keys = new.select(F.col(S.INVOICE).alias("_invoice"))
        if stored is None:
            met, parts = None, [new]
        else:
            met = materialize(stored.join(keys, same, "left_semi"))
            parts = [new, met.drop("month")]
        month = F.trunc(F.col("order_datetime").cast("date"), "month").cast("string").alias("month")
        changed = materialize(_merged(reduce(DataFrame.unionByName, parts)).select("*", month))
        seen = changed.select("month") if met is None else changed.select("month").union(met.select("month"))
        touched = sorted(r["month"] for r in seen.distinct().collect())  # one row a month
        others = self._read("orders", now["months"], touched)
        rows = changed if others is None else changed.unionByName(others.join(keys, same, "left_anti"))
        version = uuid.uuid4().hex[:12]
        path = os.path.join(self.folder, f"orders-{version}")
        rows.withColumn("_month", F.col("month")).hint("rebalance", "_month").write.partitionBy("_month").parquet(path)
        left = {n.split("=", 1)[1] for n in list_folders(self.spark, path) if n.startswith("_month=")}
        months = {m: v for m, v in now["months"].items() if m not in touched} | {m: version for m in left}
        if left:
            totals = monthly_totals(self._read("orders", {m: version for m in left}))
            (totals.withColumn("_month", F.date_format("month", "yyyy-MM-dd")).coalesce(1)
             .write.partitionBy("_month").parquet(os.path.join(self.folder, f"totals-{version}")))
        write_pointer(self.spark, self._pointer, json.dumps({"batch": batch, "months": months}))
        return touched

    def totals(self) -> DataFrame | None:
        """One row a month (see ``sales.monthly_totals``); None before the first batch."""
        return self._read("totals", self.manifest()["months"])

    def drop_unused(self) -> list[str]:
        """Delete the folders that no month of the manifest is in any more."""
        used = set(self.manifest()["months"].values())
        old = [n for n in list_folders(self.spark, self.folder) if n.split("-", 1)[0] in ("orders", "totals") and n.split("-", 1)[1] not in used]
        for name in old:
            delete_folder(self.spark, os.path.join(self.folder, name))
        return old


def start_monthly_totals(stream: DataFrame, state: MonthlyTotals, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply each micro-batch of a bronze stream to the state; the number of a batch that is
    run again is the same, so it counts once."""
    writer = stream.writeStream.foreachBatch(lambda lines, batch: state.apply(lines, batch) and None).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
