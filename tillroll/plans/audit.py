"""Data-quality audit of the consolidated lines.

All inputs are the bronze lines (or the two typed raw periods for the overlap
and per-period checks).  Several per-code loops of the original audit are one
grouped aggregation + a per-group rank here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.numeric import count_when, safe_div, strip
from tillroll.operators.heavy_values import top_heavy_values
from tillroll.operators.multiset import compare_multisets
from tillroll.operators.quantile_sketch import approx_quantiles, merged, sketch
from tillroll.operators.quantiles import describe, exact_quantiles
from tillroll.operators.topk import top_values
from tillroll.plans.parts import by_invoice, repeat_suspects
from tillroll.session import materialize
from tillroll.sources import fixture_map as FM
from tillroll.sources.reference import AUDIT_FALLBACK_CATEGORY, audit_rule_map

BUSINESS_COLUMNS = S.RAW_COLUMNS
PRICE_QUANTILES = (0.5, 0.9, 0.95, 0.99, 0.999)
PRICE_THRESHOLDS = (200, 1000, 10000)
HIGH_PRICE = 1000
# Fixed value: the product whose price series is inspected (a name present
# in the test tables; the audit inspects one product's text the same way).
PRICE_SERIES_DESCRIPTION = "small ring"


def _lines(wh) -> DataFrame:
    return wh.table("bronze")


def _is_c() -> Column:
    return F.coalesce(F.col(S.INVOICE).startswith("C"), F.lit(False))


# --------------------------------------------------------------- periods --

def audit_nulls(wh) -> DataFrame:
    """Per raw period, null count per column and date range."""
    early, late = wh.raw_periods()
    parts = []
    for df in (early, late):
        parts.append(df.groupBy(S.PERIOD).agg(
            F.count(F.lit(1)).alias("rows"),
            *[count_when(F.col(c).isNull()).alias(f"null_{c}") for c in BUSINESS_COLUMNS],
            F.min(S.INVOICE_DATE).alias("first_date"),
            F.max(S.INVOICE_DATE).alias("last_date")))
    return reduce(DataFrame.unionByName, parts)


def audit_overlap(wh) -> DataFrame:
    """R2 + J6: the shared days of both periods — sizes, common invoices and
    multiset equality of the 8 business columns (a.exceptAll(b) and
    b.exceptAll(a) both empty).  Lines collapse to one fingerprint an invoice and time;
    only lines of those that differ are moved (``operators.multiset``)."""
    lo = F.lit(FM.OVERLAP_START).cast("timestamp_ntz")
    hi = F.lit(FM.OVERLAP_END).cast("timestamp_ntz")
    sides = [df.filter((F.col(S.INVOICE_DATE) >= lo) & (F.col(S.INVOICE_DATE) < hi)) for df in wh.raw_periods()]
    keys, rows = compare_multisets(*sides, BUSINESS_COLUMNS, [S.INVOICE, S.INVOICE_DATE])
    # a.exceptAll(b) has sum(max(na - nb, 0)) rows
    more = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0)).cast("bigint")
    only = rows.agg(more("rows_a", "rows_b").alias("only_in_a"), more("rows_b", "rows_a").alias("only_in_b"))
    invoices = keys.groupBy(S.INVOICE).agg(F.sum("rows_a").alias("_a"), F.sum("rows_b").alias("_b"))
    named = F.col(S.INVOICE).isNotNull()
    out = invoices.agg(
        _whole("_a").alias("rows_a"), F.count_if(named & (F.col("_a") > 0)).alias("invoices_a"),
        _whole("_b").alias("rows_b"), F.count_if(named & (F.col("_b") > 0)).alias("invoices_b"),
        F.count_if(named & (F.col("_a") > 0) & (F.col("_b") > 0)).alias("common_invoices"))
    # one row each
    return out.crossJoin(F.broadcast(only)).select("*", (F.col("rows_a") == F.col("rows_b")).alias("same_row_count"),
                                                   ((F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)).alias("identical_rows"))


def audit_common_invoices(wh) -> DataFrame:
    """Invoices present on the shared days of both periods (distinct keys,
    semi-join)."""
    early, late = wh.raw_periods()
    lo = F.lit(FM.OVERLAP_START).cast("timestamp_ntz")
    hi = F.lit(FM.OVERLAP_END).cast("timestamp_ntz")
    in_overlap = (F.col(S.INVOICE_DATE) >= lo) & (F.col(S.INVOICE_DATE) < hi) & F.col(S.INVOICE).isNotNull()
    a = early.filter(in_overlap).select(S.INVOICE).distinct()
    b = late.filter(in_overlap).select(S.INVOICE).distinct()
    return a.join(b, S.INVOICE, "left_semi").orderBy(S.INVOICE)


# ------------------------------------------------------ quantity / price --

def audit_quantity_signs(wh) -> DataFrame:
    """negative quantities with / without a C invoice; C lines by sign."""
    d = _lines(wh)
    neg = F.col(S.QUANTITY) < 0
    c = _is_c()
    return d.agg(
        count_when(neg).alias("negative_rows"),
        F.countDistinct(F.when(neg, F.col(S.INVOICE))).alias("negative_invoices"),
        count_when(neg & c).alias("negative_on_c_rows"),
        (safe_div(count_when(neg & c), count_when(neg)) * 100).alias("negative_on_c_pct"),
        count_when(neg & ~c).alias("negative_without_c_rows"),
        (safe_div(count_when(neg & ~c), count_when(neg)) * 100).alias("negative_without_c_pct"),
        count_when(c).alias("c_rows"),
        count_when(c & neg).alias("c_negative_quantity"),
        count_when(c & (F.col(S.QUANTITY) == 0)).alias("c_zero_quantity"),
        count_when(c & (F.col(S.QUANTITY) > 0)).alias("c_positive_quantity"),
    )


def audit_positive_cancellations(wh) -> DataFrame:
    """C invoice lines with a positive quantity."""
    d = _lines(wh)
    return (d.filter(_is_c() & (F.col(S.QUANTITY) > 0)).select(*S.BRONZE_COLUMNS)
             .orderBy(S.INVOICE, S.STOCK_CODE, S.INVOICE_DATE))


def audit_top_descriptions(wh, n: int = 20) -> DataFrame:
    """Most frequent descriptions (null included) of negative lines without C."""
    d = _lines(wh).filter((F.col(S.QUANTITY) < 0) & ~_is_c())
    return top_heavy_values(d, S.DESCRIPTION, n)


def audit_price_classes(wh) -> DataFrame:
    """F12."""
    d = _lines(wh)
    p = F.col(S.PRICE)
    return d.agg(count_when(p < 0).alias("negative_price"), count_when(p == 0).alias("zero_price"),
                 count_when(p > 0).alias("positive_price"),
                 *[count_when(p > t).alias(f"price_gt_{t}") for t in PRICE_THRESHOLDS])


def audit_negative_price(wh) -> DataFrame:
    """negative-price lines."""
    d = _lines(wh).filter(F.col(S.PRICE) < 0)
    return d.select(S.INVOICE, S.STOCK_CODE, S.DESCRIPTION, S.QUANTITY, S.PRICE, S.CUSTOMER, S.COUNTRY) \
            .orderBy(S.INVOICE, S.STOCK_CODE)


def price_quantiles(wh) -> DataFrame:
    """Exact quantiles of positive prices (linear interpolation)."""
    d = _lines(wh).filter(F.col(S.PRICE) > 0)
    return exact_quantiles(d, S.PRICE, PRICE_QUANTILES).orderBy("quantile")


def _compute_price_sketch(wh) -> DataFrame:
    d = _lines(wh).filter(F.col(S.PRICE) > 0)
    return sketch(d, S.PRICE, S.PRICE_TYPE.scale, [F.trunc(F.col(S.INVOICE_DATE).cast("date"), "month").alias("month")])


def price_quantiles_approx(wh) -> DataFrame:
    """A30, opt-in for huge inputs: quantiles of positive prices from counts of cells, one
    sketch a month, stored and merged.  Beside them the exact quantiles and the true rank of
    each guess: ``rank_error`` is how far the asked position lies from the positions of the
    lines at the guessed price, as a share of all, and must not exceed ``rank_bound``."""
    derived = getattr(wh, "derived", None)
    cells = merged(derived("price_sketch", _compute_price_sketch) if derived else _compute_price_sketch(wh))
    scale = S.PRICE_TYPE.scale
    guess = materialize(approx_quantiles(cells, PRICE_QUANTILES, scale))
    # one row a quantile: a bounded broadcast; every line is compared with five numbers
    d = _lines(wh).filter(F.col(S.PRICE) > 0).select(F.col(S.PRICE).cast("double").alias("_p"))
    ranks = d.crossJoin(F.broadcast(guess.select("quantile", "value"))).groupBy("quantile").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_p") < F.col("value")).alias("_below"), F.count_if(F.col("_p") <= F.col("value")).alias("_upto"))
    exact = price_quantiles(wh).withColumnRenamed("value", "exact_value")
    at = F.floor((F.col("_all") - 1).cast("double") * F.col("quantile"))
    away = F.greatest(F.col("_below") - at, at - F.greatest(F.col("_upto") - 1, F.col("_below")), F.lit(0))
    return (guess.join(F.broadcast(ranks), "quantile").join(F.broadcast(exact), "quantile")
            .withColumn("rank_error", safe_div(away, "_all"))
            .select("quantile", "value", "low", "high", "exact_value", "rank_error", "rank_bound",
                    (F.col("rank_error") <= F.col("rank_bound")).alias("within_bound")).orderBy("quantile"))


def audit_high_price_values(wh, n: int = 20) -> DataFrame:
    """F13 + C5: top descriptions and codes among lines priced above 1000."""
    d = _lines(wh).filter(F.col(S.PRICE) > HIGH_PRICE)
    parts = []
    for field in (S.DESCRIPTION, S.STOCK_CODE):
        parts.append(top_heavy_values(d, field, n).select(F.lit(field).alias("field"),
                                                     F.col(field).alias("value"), "rows", "rank"))
    return reduce(DataFrame.unionByName, parts)


def _price_series(wh, description: str) -> DataFrame:
    return _lines(wh).filter(F.coalesce(strip(S.DESCRIPTION) == F.lit(description), F.lit(False)))


def flag_price_stats(wh, description: str = PRICE_SERIES_DESCRIPTION) -> DataFrame:
    """F14 + A29: describe() of one product's prices (text compared after strip)."""
    return describe(_price_series(wh, description), [S.PRICE])


def flag_price_counts(wh, description: str = PRICE_SERIES_DESCRIPTION) -> DataFrame:
    """that product's lines per price, by price."""
    return (_price_series(wh, description).groupBy(F.col(S.PRICE).cast("double").alias("price"))
            .agg(F.count(F.lit(1)).alias("rows")).orderBy("price"))


# -------------------------------------------------------- missing values --

def audit_missing_customer(wh) -> DataFrame:
    """C2 (+ J6 count): lines without customer id.  One read: lines collapse to
    (invoice, country) with counts, these to invoices, these to one row."""
    miss = F.col(S.CUSTOMER).isNull()
    # countries are few: their set stays small per invoice
    invoices = by_invoice(wh, lambda d: d.groupBy(S.INVOICE, S.COUNTRY).agg(
        count_when(miss).alias("_m"), F.count(F.lit(1)).alias("_n"),
        count_when(miss & (F.col(S.QUANTITY) > 0) & (F.col(S.PRICE) > 0)).alias("_p"))
        .groupBy(S.INVOICE).agg(
            F.sum("_m").alias("_m"), F.sum("_n").alias("_n"), F.sum("_p").alias("_p"),
            F.collect_set(F.when(F.col("_m") > 0, F.col(S.COUNTRY))).alias("_countries")))
    named = F.col(S.INVOICE).isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    per_set = invoices.groupBy("_countries").agg(
        F.sum("_m").alias("_m"), F.sum("_n").alias("_n"), F.sum("_p").alias("_p"),
        F.count_if(named & (F.col("_m") > 0)).alias("_i"),
        F.count_if(named & (F.col("_m") > 0) & (F.col("_m") < F.col("_n"))).alias("_x"))
    return per_set.agg(
        total("_m").alias("missing_customer_rows"), total("_n").alias("total_rows"),
        (safe_div(total("_m"), total("_n")) * 100).alias("missing_customer_pct"),
        total("_i").alias("invoices"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_countries")))).cast("bigint").alias("countries"),
        total("_p").alias("positive_quantity_price_rows"), total("_x").alias("mixed_invoices"))


def _mixed_invoices(d: DataFrame) -> DataFrame:
    return (d.filter(F.col(S.INVOICE).isNotNull()).groupBy(S.INVOICE)
             .agg(count_when(F.col(S.CUSTOMER).isNull()).alias("rows_without_customer"),
                  count_when(F.col(S.CUSTOMER).isNotNull()).alias("rows_with_customer"))
             .filter((F.col("rows_without_customer") > 0) & (F.col("rows_with_customer") > 0)))


def audit_mixed_invoices(wh) -> DataFrame:
    """Invoices holding lines with and without a customer id."""
    return by_invoice(wh, _mixed_invoices).orderBy(S.INVOICE)


def audit_missing_customer_by_country(wh) -> DataFrame:
    """C3 + J5: one conditional aggregation instead of joining two value counts."""
    d = _lines(wh).filter(F.col(S.COUNTRY).isNotNull())
    miss = F.col(S.CUSTOMER).isNull()
    return (d.groupBy(S.COUNTRY).agg(count_when(miss).alias("missing_customer_rows"),
                                    F.count(F.lit(1)).alias("total_rows"))
             .filter(F.col("missing_customer_rows") > 0)
             .withColumn("missing_rate_pct", safe_div("missing_customer_rows", "total_rows") * 100)
             .orderBy(F.col("missing_customer_rows").desc(), S.COUNTRY))


def audit_missing_description(wh) -> DataFrame:
    """C4."""
    d = _lines(wh)
    miss = F.col(S.DESCRIPTION).isNull()
    return d.agg(
        count_when(miss).alias("missing_description_rows"),
        (safe_div(count_when(miss), F.count(F.lit(1))) * 100).alias("missing_description_pct"),
        count_when(miss & (F.col(S.QUANTITY) < 0)).alias("negative_quantity"),
        count_when(miss & (F.col(S.QUANTITY) > 0)).alias("positive_quantity"),
        count_when(miss & (F.col(S.PRICE) == 0)).alias("zero_price"),
        count_when(miss & (F.col(S.PRICE) > 0)).alias("positive_price"),
        count_when(miss & F.col(S.CUSTOMER).isNull()).alias("missing_customer"))


def audit_missing_description_codes(wh, n: int = 30) -> DataFrame:
    """Codes of the lines without description."""
    return top_values(_lines(wh).filter(F.col(S.DESCRIPTION).isNull()), S.STOCK_CODE, n)


# ------------------------------------------------------------ duplicates --

def _repeat_groups(wh, cols: list[str]) -> DataFrame:
    """Groups of lines that are equal in ``cols`` (nulls equal) with their size ``n`` > 1:
    only lines that may have an equal are compared (see ``operators.repeat_filter``)."""
    return repeat_suspects(wh).groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _whole(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def audit_duplicates(wh) -> DataFrame:
    """Exact repeats over all 9 columns.  All lines are only counted."""
    counts = _repeat_groups(wh, S.BRONZE_COLUMNS).withColumn("more", F.col("n") - 1).agg(
        _whole("more").alias("surplus_rows"), _whole("n").alias("rows_in_groups"), F.countDistinct(S.INVOICE).alias("invoices"))
    total = _lines(wh).agg(F.count(F.lit(1)).alias("total_rows"))
    # one row each
    return counts.crossJoin(F.broadcast(total)).withColumn("surplus_pct", safe_div("surplus_rows", "total_rows") * 100)


def audit_duplicate_sizes(wh) -> DataFrame:
    """How many repeat groups of each size (8 business columns, nulls kept)."""
    g = _repeat_groups(wh, BUSINESS_COLUMNS)
    return g.groupBy(F.col("n").alias("group_size")).agg(F.count(F.lit(1)).alias("groups")).orderBy("group_size")


def audit_duplicate_rows(wh, n: int = 30) -> DataFrame:
    """Rows that belong to a repeat group (all 9 columns), first n by invoice, code, time."""
    s = wh.table("silver_transactions").filter(F.col("is_repeated_row"))
    order = [S.INVOICE, S.STOCK_CODE, S.INVOICE_DATE, S.DESCRIPTION, S.QUANTITY, S.PRICE, S.CUSTOMER, S.COUNTRY]
    return (s.select(*BUSINESS_COLUMNS).orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n))


def audit_dedup_impact(wh) -> DataFrame:
    """Effect of dropping exact repeats: totals of all lines, less what the surplus
    lines of the repeat groups add."""
    v = F.col(S.QUANTITY).cast("decimal(20,0)") * F.col(S.PRICE)
    whole = _lines(wh).agg(F.count(F.lit(1)).alias("rows_before"), F.sum(v).alias("_all"))
    more = F.col("n") - 1
    surplus = _repeat_groups(wh, S.BRONZE_COLUMNS).agg(F.coalesce(F.sum(more), F.lit(0)).cast("bigint").alias("_surplus"),
                                                       F.coalesce(F.sum(v * more), F.lit(0)).alias("_more"))
    # one row each
    agg = whole.crossJoin(F.broadcast(surplus)).select(
        "rows_before", (F.col("rows_before") - F.col("_surplus")).alias("rows_after"), "_all", (F.col("_all") - F.col("_more")).alias("_dedup"))
    return agg.select(
        "rows_before", "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        (safe_div(F.col("rows_before") - F.col("rows_after"), "rows_before") * 100).alias("reduction_pct"),
        F.col("_all").cast("double").alias("value_all"),
        F.col("_dedup").cast("double").alias("value_deduplicated"),
        (F.col("_all") - F.col("_dedup")).cast("double").alias("difference"),
        (safe_div(F.col("_all") - F.col("_dedup"), "_all") * 100).alias("relative_difference_pct"))


# -------------------------------------------------------- invoices / codes --

def audit_invoice_prefix(wh) -> DataFrame:
    """Leading letters of the invoice, else NUMERIC."""
    d = _lines(wh)
    prefix = F.coalesce(F.nullif(F.regexp_extract(S.INVOICE, r"^([A-Za-z]+)", 1), F.lit("")), F.lit("NUMERIC"))
    return d.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("rows")) \
            .orderBy(F.col("rows").desc(), "prefix")


def audit_a_invoices(wh) -> DataFrame:
    """Lines on invoices starting with A, by time."""
    d = _lines(wh).filter(F.coalesce(F.col(S.INVOICE).startswith("A"), F.lit(False)))
    return d.select(*BUSINESS_COLUMNS).orderBy(S.INVOICE_DATE, S.INVOICE, S.STOCK_CODE)


def _special_lines(wh) -> DataFrame:
    # codes that do not start with a digit (a null code counts as special)
    return _lines(wh).filter(~F.coalesce(F.col(S.STOCK_CODE).rlike(r"^\d"), F.lit(False)))


def audit_special_codes(wh) -> DataFrame:
    """C11 + J4 + W7: inventory of special codes with their main description."""
    sp = _special_lines(wh).filter(F.col(S.STOCK_CODE).isNotNull())
    inv = sp.groupBy(S.STOCK_CODE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(S.DESCRIPTION).alias("descriptions"),
        count_when(_is_c()).alias("cancellations"),
        count_when(F.col(S.QUANTITY) < 0).alias("negative_quantity"),
        count_when(F.col(S.PRICE) == 0).alias("zero_price"),
        F.min(S.PRICE).cast("double").alias("min_price"),
        F.max(S.PRICE).cast("double").alias("max_price"),
        F.sum(S.QUANTITY).cast("bigint").alias("total_quantity"))
    # main description = the per-code top-1 of the description counts (salted, see topk)
    main = top_values(sp, S.DESCRIPTION, 1, group_cols=(S.STOCK_CODE,), count_col="description_rows").drop("rank")
    return inv.join(main, S.STOCK_CODE, "left").orderBy(F.col("rows").desc(), S.STOCK_CODE)


def audit_special_code_descriptions(wh, n: int = 10) -> DataFrame:
    """C5 per code: the n most frequent descriptions of each special code."""
    sp = _special_lines(wh).filter(F.col(S.STOCK_CODE).isNotNull())
    return top_values(sp, S.DESCRIPTION, n, group_cols=(S.STOCK_CODE,))


def _rules(wh) -> DataFrame:
    return wh.spark.createDataFrame(audit_rule_map(), "rule_code string, rule_category string")


def _classified(wh) -> DataFrame:
    codes = _special_lines(wh).filter(F.col(S.STOCK_CODE).isNotNull()).select(S.STOCK_CODE).distinct()
    # the rule lists are a fixed literal table (≤ 62 rows): bounded broadcast.
    j = codes.join(F.broadcast(_rules(wh)), codes[S.STOCK_CODE] == F.col("rule_code"), "left")
    return j.select(F.col(S.STOCK_CODE).alias("stock_code"),
                    F.coalesce(F.col("rule_category"), F.lit("unknown")).alias("rule_category"))


def audit_classification(wh) -> DataFrame:
    """C12 + S10: special code → category; codes no rule lists are stock movements."""
    c = _classified(wh)
    return c.select("stock_code",
                    F.when(F.col("rule_category") == "unknown", F.lit(AUDIT_FALLBACK_CATEGORY))
                     .otherwise(F.col("rule_category")).alias("category")).orderBy("stock_code")


def audit_category_counts(wh) -> DataFrame:
    """Codes per category, before (rules only) and after the fallback, from one
    count per rule category (≤ 10 rows)."""
    final = F.when(F.col("rule_category") == "unknown", F.lit(AUDIT_FALLBACK_CATEGORY)).otherwise(F.col("rule_category"))
    counts = _classified(wh).groupBy("rule_category").agg(F.count(F.lit(1)).alias("n"))
    sides = counts.select("n", F.explode(F.array(
        F.struct(F.col("rule_category").alias("category"), F.lit(True).alias("by_rules")),
        F.struct(final.alias("category"), F.lit(False).alias("by_rules")))).alias("s"))
    return (sides.groupBy("s.category").agg(F.sum(F.when(F.col("s.by_rules"), F.col("n"))).alias("codes_by_rules"),
                                            F.sum(F.when(~F.col("s.by_rules"), F.col("n"))).alias("codes_final"))
            .orderBy("category"))


def audit_unclassified_codes(wh) -> DataFrame:
    """C13 + J7: every line of the codes no rule list covers (semi-join)."""
    unknown = _classified(wh).filter(F.col("rule_category") == "unknown").select(F.col("stock_code").alias(S.STOCK_CODE))
    d = _lines(wh).join(unknown, S.STOCK_CODE, "left_semi")
    return d.select(*BUSINESS_COLUMNS).orderBy(S.STOCK_CODE, S.INVOICE, S.INVOICE_DATE)


def audit_invoice_grain(wh) -> DataFrame:
    """C14: per invoice distinct dates / customers / countries; maxima and >1 counts.
    Distinct values are counted per invoice as small sets after one reduction, where the
    invoice's lines lie together: nothing but one row a task is moved."""
    g = by_invoice(wh, lambda d: d.groupBy(S.INVOICE, S.INVOICE_DATE, S.CUSTOMER, S.COUNTRY).agg(F.count(F.lit(1)).alias("_n"))
                      .groupBy(S.INVOICE).agg(
        *[F.size(F.collect_set(c)).cast("bigint").alias(name) for c, name in
          ((S.INVOICE_DATE, "dates"), (S.CUSTOMER, "customers"), (S.COUNTRY, "countries"))]))
    return g.agg(F.max("dates").alias("max_dates"), F.max("customers").alias("max_customers"),
                 F.max("countries").alias("max_countries"),
                 count_when(F.col("dates") > 1).alias("invoices_multi_dates"),
                 count_when(F.col("customers") > 1).alias("invoices_multi_customers"),
                 count_when(F.col("countries") > 1).alias("invoices_multi_countries"))


def _multi_timestamp(wh) -> DataFrame:
    """Invoices whose first and last timestamps differ."""
    return by_invoice(wh, lambda d: d.filter(F.col(S.INVOICE).isNotNull()).groupBy(S.INVOICE)
                         .agg(F.min(S.INVOICE_DATE).alias("first_date"), F.max(S.INVOICE_DATE).alias("last_date"),
                              F.count(F.lit(1)).alias("rows"))
                         .filter(F.col("first_date") < F.col("last_date")))


def audit_multi_timestamp(wh) -> DataFrame:
    """Invoices with several timestamps — first, last, rows, gap, same day."""
    gap = F.timestamp_diff("SECOND", F.col("first_date"), F.col("last_date")).cast("double") / F.lit(60.0)
    return (_multi_timestamp(wh).withColumn("gap_minutes", gap)
            .withColumn("same_day", F.col("first_date").cast("date") == F.col("last_date").cast("date"))
            .orderBy(F.col("gap_minutes").desc(), S.INVOICE))


def audit_gap_stats(wh) -> DataFrame:
    """C15 + A29: describe() of the gap of multi-timestamp invoices, in minutes.

    Described exactly in whole seconds, then scaled (minutes = seconds / 60)."""
    gaps = _multi_timestamp(wh).select(
        F.timestamp_diff("SECOND", F.col("first_date"), F.col("last_date")).alias("gap_seconds"))
    d = describe(gaps, ["gap_seconds"])
    return d.select(F.lit("gap_minutes").alias("column"), "count",
                    *[(F.col(c) / F.lit(60.0)).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def audit_multi_country(wh) -> DataFrame:
    """Identified customers seen in several countries (null ids filtered first)."""
    d = _lines(wh).filter(F.col(S.CUSTOMER).isNotNull())
    return (d.groupBy(S.CUSTOMER).agg(F.countDistinct(S.COUNTRY).alias("countries"))
             .filter(F.col("countries") > 1).orderBy(F.col("countries").desc(), S.CUSTOMER))


def audit_descriptions_per_code(wh) -> DataFrame:
    """C17: distinct descriptions per code (null code kept as a group)."""
    return (_lines(wh).groupBy(S.STOCK_CODE).agg(F.countDistinct(S.DESCRIPTION).alias("descriptions"))
            .orderBy(F.col("descriptions").desc(), F.col(S.STOCK_CODE).asc_nulls_last()))


def audit_multi_description_examples(wh, codes: int = 5, n: int = 15) -> DataFrame:
    """C17 → C5: the 5 codes with most descriptions, and their 15 most frequent texts."""
    top = (audit_descriptions_per_code(wh).filter(F.col("descriptions") > 1).limit(codes)
           .select(S.STOCK_CODE))
    # ≤ `codes` rows: bounded broadcast for the semi-join.
    d = _lines(wh).join(F.broadcast(top), S.STOCK_CODE, "left_semi")
    return top_values(d, S.DESCRIPTION, n, group_cols=(S.STOCK_CODE,))


def audit_extreme_quantity(wh) -> DataFrame:
    """the lines whose absolute quantity is the largest."""
    d = _lines(wh)
    mx = d.agg(F.max(F.abs(S.QUANTITY)).alias("_max"))
    return (d.crossJoin(F.broadcast(mx)).filter(F.abs(S.QUANTITY) == F.col("_max"))  # one-row max
             .select(*BUSINESS_COLUMNS).orderBy(S.INVOICE_DATE, S.INVOICE))
