"""Warehouse layers as DataFrame → DataFrame functions.

bronze → silver (flags, category, repeat flag) → fact_order_lines →
fact_orders / dim_customers / dim_products → customer_rfm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import flags as FL
from tillroll.functions.numeric import count_when
from tillroll.functions.scoring import frequency_score, quintile_from_bounds, segment
from tillroll.operators.ranks import with_score
from tillroll.operators.repeat_filter import repeat_filter
from tillroll.operators.repeats import with_repeat_count
from tillroll.session import materialize

LINE_FLAGS = S.QUALITY_FLAGS


def repeat_suspects(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The bronze lines that equal no other in the eight business columns for certain, and
    those that may: only these have to meet their equals (``bronze``: a stored table)."""
    suspect = repeat_filter(bronze, S.RAW_COLUMNS).suspect()
    lines = bronze.select(*S.BRONZE_COLUMNS)
    return lines.where(~suspect), lines.where(suspect)


def silver(bronze: DataFrame, categories: DataFrame, parts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per bronze row, 19 columns.  ``parts``: the lines that have
    no equal and the suspects (``repeat_suspects``).  Only suspects are shuffled."""
    alone, suspects = parts or repeat_suspects(bronze)
    counted = alone.withColumn("_repeats", F.lit(1).cast("bigint")).unionByName(with_repeat_count(suspects, "_repeats"))
    return flagged(counted, categories)


def flagged(counted: DataFrame, categories: DataFrame) -> DataFrame:
    """The silver columns of bronze lines with ``_repeats``, the number of lines equal to each."""
    # the special-code table has a fixed 62 rows: bounded broadcast.
    ref = F.broadcast(categories.select(F.col("stock_code").alias("_ref_code"),
                                        F.col("category").alias("_ref_category")))
    joined = counted.join(ref, counted[S.STOCK_CODE] == ref["_ref_code"], "left")
    return with_flags(joined.select(
        *S.BRONZE_COLUMNS,
        F.coalesce(F.col("_ref_category"), F.lit(FL.PRODUCT)).alias("line_category"),
        F.col("_ref_code").isNotNull().alias("is_special_stockcode"),
        (F.col("_repeats") > 1).alias("is_repeated_row"),
    ))


#: The silver columns from which a line's others follow.
SEED_COLUMNS = [*S.BRONZE_COLUMNS, "line_category", "is_special_stockcode", "is_repeated_row"]


def with_flags(seeds: DataFrame) -> DataFrame:
    """The silver columns of lines that have ``SEED_COLUMNS``."""
    return seeds.select(
        *S.BRONZE_COLUMNS,
        FL.is_cancellation().alias("is_cancellation"),
        FL.is_negative_quantity().alias("is_negative_quantity"),
        FL.is_zero_price().alias("is_zero_price"),
        FL.is_negative_price().alias("is_negative_price"),
        FL.is_missing_customer().alias("is_missing_customer"),
        FL.is_missing_description().alias("is_missing_description"),
        "is_special_stockcode",
        "is_repeated_row",
        "line_category",
        FL.raw_line_value().alias("raw_line_value"),
    )


def fact_order_lines(silver_df: DataFrame) -> DataFrame:
    """24 columns, line grain."""
    sale = FL.is_product_sale()
    cancel = FL.is_product_cancellation()
    return silver_df.select(
        *S.BRONZE_COLUMNS,
        "line_category",
        *LINE_FLAGS,
        "raw_line_value",
        sale.alias("is_product_sale"),
        cancel.alias("is_product_cancellation"),
        FL.value_if(sale).alias("gross_product_sales_value"),
        FL.value_if(cancel).alias("product_cancellation_value"),
        FL.value_if(sale | cancel).alias("net_product_sales_value"),
    )


def fact_orders(lines: DataFrame) -> DataFrame:
    """A1: one row per invoice, 18 columns.

    Spark cannot hash-aggregate a maximum of strings, so the lines are first reduced by
    (invoice, code, country, period) with numeric aggregates only; the strings are
    compared on the reduced rows.  A sale has a positive quantity and a cancellation a
    negative one, so the sums of quantities tell whether there was any, and the net value
    is the sum of both values: none of these is summed line by line again."""
    sale, cancel = F.col("is_product_sale"), F.col("is_product_cancellation")
    quantity = F.col(S.QUANTITY)
    reduced = lines.groupBy(S.INVOICE, S.STOCK_CODE, S.COUNTRY, S.PERIOD).agg(
        F.min(S.INVOICE_DATE).alias("first"),
        F.max(S.INVOICE_DATE).alias("last"),
        F.max(S.CUSTOMER).alias("customer"),
        F.count(F.lit(1)).alias("lines"),
        F.sum(quantity).alias("quantity"),
        F.sum("raw_line_value").alias("raw"),
        F.sum(F.when(sale, quantity).otherwise(0)).alias("sold"),
        F.sum(F.when(cancel, quantity).otherwise(0)).alias("taken_back"),
        F.sum("gross_product_sales_value").alias("gross"),
        F.sum("product_cancellation_value").alias("cancelled"),
        F.bool_or("is_cancellation").alias("is_c"),
    )
    return reduced.groupBy(S.INVOICE).agg(
        F.min("first").alias("order_datetime"),
        F.max("last").alias("last_line_datetime"),
        F.max("customer").alias("customer_id"),
        F.max(S.COUNTRY).alias("country"),
        F.min(S.PERIOD).alias("source_period"),
        F.sum("lines").alias("line_count"),
        F.countDistinct(S.STOCK_CODE).alias("distinct_stockcodes"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("raw").cast("decimal(38,4)").alias("raw_order_value"),
        F.sum("sold").alias("product_sale_quantity"),
        F.sum("taken_back").alias("product_cancellation_quantity"),
        F.sum("gross").cast("decimal(38,4)").alias("gross_product_sales_value"),
        F.sum("cancelled").cast("decimal(38,4)").alias("product_cancellation_value"),
        (F.sum("gross").cast("decimal(38,4)") + F.sum("cancelled").cast("decimal(38,4)")).cast("decimal(38,4)").alias("net_product_sales_value"),
        F.bool_or("is_c").alias("is_cancellation"),
        (F.sum("sold") > 0).alias("has_product_sale"),
        (F.sum("taken_back") < 0).alias("has_product_cancellation"),
    )


def dim_customers(orders: DataFrame) -> DataFrame:
    """A2: identified customers only (null ids filtered before the shuffle).  Reduced by
    (customer, country) first; the latest country (ties: the last by name) is picked
    among a customer's countries."""
    by_country = (orders.filter(F.col("customer_id").isNotNull())
                  .groupBy("customer_id", "country").agg(
                      F.min("order_datetime").alias("first"), F.max("order_datetime").alias("last"),
                      F.count(F.lit(1)).alias("invoices")))
    latest = F.when(F.col("country").isNotNull(), F.struct("last", "country"))
    return by_country.groupBy("customer_id").agg(
        F.min("first").alias("first_activity_datetime"),
        F.max("last").alias("last_activity_datetime"),
        F.sum("invoices").alias("invoice_count"),
        F.count("country").alias("distinct_countries"),
        (F.count("country") > 1).alias("is_multi_country"),
        F.max_by("country", latest).alias("latest_country"))


def dim_products(lines: DataFrame) -> DataFrame:
    """A3: one row per stock code; latest non-null description (ties: the last by text).
    Reduced by (code, description, category) first; a code has one category."""
    texts = lines.groupBy(S.STOCK_CODE, S.DESCRIPTION, "line_category").agg(
        F.min(S.INVOICE_DATE).alias("first"), F.max(S.INVOICE_DATE).alias("last"))
    latest = F.when(F.col(S.DESCRIPTION).isNotNull(), F.struct("last", S.DESCRIPTION))
    return texts.groupBy(F.col(S.STOCK_CODE).alias("stock_code")).agg(
        F.max_by(S.DESCRIPTION, latest).alias("product_description"),
        F.max("line_category").alias("line_category"),
        F.min("first").alias("first_seen_datetime"),
        F.max("last").alias("last_seen_datetime"),
        F.count(S.DESCRIPTION).alias("distinct_descriptions"))


def rfm_reference_date(orders: DataFrame) -> DataFrame:
    """A5: one row — day after the last purchase day."""
    return (orders.filter(F.col("has_product_sale"))
            .agg(F.date_add(F.max(F.col("order_datetime").cast("date")), 1).alias("rfm_reference_date")))


def rfm_base(orders: DataFrame) -> DataFrame:
    """A4: customers with at least one purchase; monetary rounded to cents."""
    sale = F.col("has_product_sale")
    return (orders.filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id").agg(
                F.max(F.when(sale, F.col("order_datetime"))).alias("last_purchase_datetime"),
                count_when(sale).alias("frequency"),
                F.round(F.sum("net_product_sales_value"), 2).alias("monetary_exact"))
            .filter(F.col("frequency") > 0))


def customer_rfm(orders: DataFrame) -> DataFrame:
    """12 columns, one row per purchasing customer."""
    # one-row reference date: a bounded broadcast instead of a driver round trip.
    base = rfm_base(orders).crossJoin(F.broadcast(rfm_reference_date(orders)))
    base = base.withColumn(
        "recency",
        F.datediff(F.col("rfm_reference_date"), F.col("last_purchase_datetime").cast("date")).cast("bigint"))
    # the customer aggregate feeds two rank passes: compute it once
    base = materialize(base)

    quintile = quintile_from_bounds(F.col("rank_lo"), F.col("rank_hi"), F.col("rank_n"))
    m = with_score(with_score(base, "recency", F.lit(6) - quintile, "r_score"), "monetary_exact", quintile, "m_score")

    scored = m.withColumn("f_score", frequency_score("frequency"))
    return scored.select(
        "customer_id",
        "last_purchase_datetime",
        "recency",
        F.col("frequency").cast("bigint").alias("frequency"),
        F.col("monetary_exact").cast("double").alias("monetary"),
        "r_score", "f_score", "m_score",
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                 F.col("m_score").cast("string")).alias("rfm_code"),
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("int").alias("rfm_total_score"),
        segment().alias("segment"),
        "rfm_reference_date",
    )
