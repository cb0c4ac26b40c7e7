"""Customer value, RFM and concentration reports.

Customer-grain inputs filter null ids *before* grouping (the missing-customer
group is the largest key).  The Pareto table uses ``ranks.running_totals``
(range buckets + per-bucket windows), never a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import count_when, rounded_money, safe_div
from tillroll.functions.scoring import (FREQUENCY_BANDS, SEGMENT_DISPLAY_ORDER, frequency_band)
from tillroll.operators.quantiles import describe
from tillroll.operators.ranks import Key, running_totals

PARETO_THRESHOLDS = (1, 5, 10, 20)
PARETO_TARGET_PCT = 80.0


def _exact_monetary() -> Column:
    # monetary is a 2-decimal amount stored as double: back to exact cents
    return F.col("monetary").cast("decimal(38,2)")


# -------------------------------------------------------------- dashboard --

def kpi_rfm(wh) -> DataFrame:
    rfm = wh.table("customer_rfm")
    champ = F.col("segment") == "Champions"
    return rfm.agg(
        F.count(F.lit(1)).alias("rfm_customers"),
        count_when(champ).alias("champions"),
        safe_div(F.sum(F.when(champ, _exact_monetary())), F.sum(_exact_monetary())).alias("champions_value_share"),
        count_when(F.col("segment") == "At Risk").alias("at_risk_customers"),
    )


def _segment_aggs() -> list[Column]:
    n = F.count(F.lit(1))
    return [
        n.alias("customers"),
        safe_div(F.sum("recency"), n).alias("average_recency"),
        safe_div(F.sum("frequency"), n).alias("average_frequency"),
        safe_div(F.sum(_exact_monetary()), n).alias("average_monetary"),
        F.sum(_exact_monetary()).alias("_total_exact"),
    ]


def _with_share(seg: DataFrame, name: str, scale: float) -> DataFrame:
    # ≤ 6 segment rows: the grand total is a one-row aggregate, broadcast back.
    total = seg.agg(F.sum("_total_exact").alias("_grand"))
    return (seg.crossJoin(F.broadcast(total))
               .withColumn("total_monetary", F.col("_total_exact").cast("double"))
               .withColumn(name, safe_div("_total_exact", "_grand") * F.lit(scale) if scale != 1.0
                           else safe_div("_total_exact", "_grand"))
               .drop("_total_exact", "_grand"))


def segment_profile(wh) -> DataFrame:
    """A10 + W3: per segment, sorted by customers."""
    seg = wh.table("customer_rfm").groupBy("segment").agg(*_segment_aggs())
    return _with_share(seg, "value_share", 1.0).orderBy(F.col("customers").desc(), "segment")


def segment_profile_by_value(wh) -> DataFrame:
    """A10, second view: the segment profile sorted by its share of the value."""
    return segment_profile(wh).orderBy(F.col("value_share").desc(), "segment")


def segment_value(wh) -> DataFrame:
    """Per segment, sorted by value, share in percent."""
    seg = wh.table("customer_rfm").groupBy("segment").agg(*_segment_aggs())
    return _with_share(seg, "sales_share_pct", 100.0).orderBy(F.col("total_monetary").desc(), "segment")


def segment_distribution(wh) -> DataFrame:
    """A38 + K10 + J8: customers per segment, percent rounded half-even, and
    the fixed display order (segments without customers listed with null)."""
    rfm = wh.table("customer_rfm")
    counts = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    total = rfm.agg(F.count(F.lit(1)).alias("_n"))
    labels = wh.spark.createDataFrame([(i + 1, s) for i, s in enumerate(SEGMENT_DISPLAY_ORDER)],
                                      "display_order int, segment string")
    pct = safe_div("customers", "_n") * 100
    # labels and total are fixed-size (6 rows, 1 row): bounded broadcasts.
    return (F.broadcast(labels).join(counts, "segment", "left").crossJoin(F.broadcast(total))
            .select("display_order", "segment", "customers",
                    (F.bround(pct * 100, 0) / 100).alias("customer_pct"))
            .orderBy("display_order"))


def customer_explorer(wh, segment: str | None = None) -> DataFrame:
    """6 columns, optional segment filter ('All' = no filter), by monetary."""
    rfm = wh.table("customer_rfm")
    if segment and segment != "All":
        rfm = rfm.filter(F.col("segment") == F.lit(segment))
    return (rfm.select("customer_id", "recency", "frequency", "monetary", "rfm_total_score", "segment")
               .orderBy(F.col("monetary").desc(), "customer_id"))


def segment_list(wh) -> DataFrame:
    """'All' first, then the distinct segments sorted."""
    segs = wh.table("customer_rfm").select("segment").distinct()
    first = wh.spark.createDataFrame([("All",)], "segment string")
    return (first.withColumn("position", F.lit(0))
            .unionByName(segs.withColumn("position", F.lit(1)))
            .orderBy("position", "segment").select("segment", "position"))


def score_distribution(wh) -> DataFrame:
    """Customers per (score type, score)."""
    rfm = wh.table("customer_rfm").select("r_score", "f_score", "m_score")
    long = rfm.unpivot([], ["r_score", "f_score", "m_score"], "score_type", "score")
    return long.groupBy("score_type", "score").agg(F.count(F.lit(1)).alias("customers")) \
               .orderBy("score_type", "score")


def rfm_stats(wh) -> DataFrame:
    """describe() of recency, frequency, monetary."""
    rfm = wh.table("customer_rfm").withColumn("monetary", _exact_monetary())
    return describe(rfm, ["recency", "frequency", "monetary"])


def check_rfm(wh) -> DataFrame:
    """K9 + K11: grain, ranges and sanity counts of the RFM table."""
    rfm = wh.table("customer_rfm")
    score_ok = F.bool_and(F.col("r_score").between(1, 5) & F.col("f_score").between(1, 5)
                          & F.col("m_score").between(1, 5))
    return rfm.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("customer_id").alias("customers"),
        (F.count(F.lit(1)) == F.countDistinct("customer_id")).alias("grain_valid"),
        F.min("recency").alias("min_recency"),
        F.max("recency").alias("max_recency"),
        F.min("rfm_total_score").alias("min_score"),
        F.max("rfm_total_score").alias("max_score"),
        count_when(F.col("monetary") <= 0).alias("monetary_le_0"),
        count_when(F.col("recency") < 0).alias("recency_lt_0"),
        count_when(F.col("frequency") <= 0).alias("frequency_le_0"),
        score_ok.alias("scores_valid"),
    )


# ---------------------------------------------------------- orders / customers --

def _compute_purchase_counts(wh) -> DataFrame:
    fo = wh.table("fact_orders").filter(F.col("customer_id").isNotNull())
    return (fo.groupBy("customer_id").agg(count_when(F.col("has_product_sale")).alias("purchase_count"))
              .filter(F.col("purchase_count") > 0))


def _purchase_counts(wh) -> DataFrame:
    """Purchases per identified customer, stored once: three reports read it."""
    derived = getattr(wh, "derived", None)
    return (derived("customer_purchase_counts", _compute_purchase_counts) if derived
            else _compute_purchase_counts(wh))


def customer_frequency(wh) -> DataFrame:
    """Purchases per identified customer (> 0), most frequent first."""
    return _purchase_counts(wh).orderBy(F.col("purchase_count").desc(), "customer_id")


def frequency_stats(wh) -> DataFrame:
    return describe(_purchase_counts(wh), ["purchase_count"])


def frequency_distribution(wh) -> DataFrame:
    """A27 + J8: customers per frequency band in the fixed band order."""
    cf = _purchase_counts(wh)
    counts = cf.groupBy(frequency_band("purchase_count").alias("frequency_group")) \
               .agg(F.count(F.lit(1)).alias("customers"))
    labels = wh.spark.createDataFrame([(i + 1, b) for i, b in enumerate(FREQUENCY_BANDS)],
                                      "band_order int, frequency_group string")
    return (F.broadcast(labels).join(counts, "frequency_group", "left")
            .select("band_order", "frequency_group", "customers").orderBy("band_order"))


def _customer_value(wh) -> DataFrame:
    fo = wh.table("fact_orders").filter(F.col("customer_id").isNotNull())
    return (fo.groupBy("customer_id")
              .agg(F.round(F.sum("net_product_sales_value"), 2).alias("net_exact"),
                   F.sum("net_product_sales_value").alias("_net"))
              .filter(F.col("_net") > 0).drop("_net"))


def _pareto(wh) -> DataFrame:
    cv = _customer_value(wh)
    rt = running_totals(cv, [Key("net_exact", False), Key("customer_id")], ["net_exact"])
    return rt.select(
        "customer_id",
        F.col("net_exact").cast("double").alias("net_product_sales"),
        F.col("net_exact_cum").cast("double").alias("cumulative_sales"),
        (safe_div("net_exact_cum", "net_exact_total") * 100).alias("cumulative_sales_pct"),
        (safe_div("row_pos", "total_rows") * 100).alias("cumulative_customers_pct"),
        F.col("net_exact"),
        F.col("net_exact_total"),
    )


def _value_curve(wh) -> DataFrame:
    """The Pareto table, stored once: three reports read it."""
    derived = getattr(wh, "derived", None)
    return derived("customer_value_curve", _pareto) if derived else _pareto(wh)


def customer_pareto(wh) -> DataFrame:
    """A28 + W4: customers by value (desc, id), running value and shares."""
    return _value_curve(wh).drop("net_exact", "net_exact_total")


def pareto_top_shares(wh) -> DataFrame:
    """Value share of the top 1 / 5 / 10 / 20 % customers."""
    p = _value_curve(wh)
    cols = []
    for t in PARETO_THRESHOLDS:
        part = F.sum(F.when(F.col("cumulative_customers_pct") <= t, F.col("net_exact")))
        cols.append((safe_div(F.coalesce(part, F.lit(0)), F.max("net_exact_total")) * 100).alias(f"top_{t}"))
    row = p.agg(*cols)
    return row.unpivot([], [f"top_{t}" for t in PARETO_THRESHOLDS], "top_bucket", "sales_share_pct") \
              .select(F.regexp_extract("top_bucket", r"(\d+)", 1).cast("int").alias("top_customers_pct"),
                      "sales_share_pct")


def pareto_80(wh) -> DataFrame:
    """Share of customers needed to reach 80 % of the value."""
    p = _value_curve(wh)
    return p.filter(F.col("cumulative_sales_pct") >= PARETO_TARGET_PCT).agg(
        F.min("cumulative_customers_pct").alias("customers_for_80_pct"))


def customer_overview(wh) -> DataFrame:
    """A35."""
    fo = wh.table("fact_orders")
    return fo.agg(F.countDistinct("customer_id").alias("identified_customers"),
                  count_when(F.col("customer_id").isNull()).alias("invoices_without_customer"),
                  # one row an invoice, so the invoices needn't be made distinct
                  count_when(F.col("customer_id").isNotNull() & F.col("Invoice").isNotNull())
                   .alias("invoices_with_customer"))


def customer_preview(wh, n: int = 20) -> DataFrame:
    """Top customers by net value (ties by id)."""
    fo = wh.table("fact_orders").filter(F.col("customer_id").isNotNull())
    agg = fo.groupBy("customer_id").agg(
        F.min("order_datetime").alias("first_activity_datetime"),
        F.max("order_datetime").alias("last_activity_datetime"),
        F.count(F.lit(1)).alias("invoice_count"),
        count_when(F.col("has_product_sale")).alias("purchase_invoice_count"),
        count_when(F.col("has_product_cancellation")).alias("cancellation_invoice_count"),
        F.countDistinct("country").alias("distinct_countries"),
        rounded_money(F.sum("gross_product_sales_value")).alias("gross_product_sales_value"),
        rounded_money(F.sum("product_cancellation_value")).alias("product_cancellation_value"),
        rounded_money(F.sum("net_product_sales_value")).alias("net_product_sales_value"))
    return agg.orderBy(F.col("net_product_sales_value").desc(), "customer_id").limit(n)


def multi_country_customers(wh) -> DataFrame:
    """customers seen in several countries."""
    return wh.table("dim_customers").filter(F.col("is_multi_country")).orderBy("customer_id")


def export_rfm(wh) -> DataFrame:
    """The RFM extract, ordered by customer id."""
    rfm = wh.table("customer_rfm")
    return rfm.select("customer_id", "last_purchase_datetime", "recency",
                      F.col("frequency").cast("bigint").alias("frequency"), "monetary",
                      "r_score", "f_score", "m_score", "rfm_code", "rfm_total_score", "segment",
                      "rfm_reference_date").orderBy("customer_id")
