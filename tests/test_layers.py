"""Layers (1) and (3): hand-made edge cases for the warehouse layers, and
invariants on the supplied tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.plans import layers
from tillroll.sources.reference import stockcode_categories


def _bronze(spark, rows):
    return spark.createDataFrame(rows, S.BRONZE_SCHEMA)


def _t(h, m=0, d=1):
    return dt.datetime(2011, 1, d, h, m)


def test_silver_flags_categories_and_repeats(spark):
    rows = [
        ("C1", "POST", None, -1, _t(9), Decimal("5.0000"), None, "FR", "p"),
        ("C1", "POST", None, -1, _t(9), Decimal("5.0000"), None, "FR", "p"),
        ("2", "M", "manual", 1, _t(9), Decimal("0.0000"), 5, "FR", "p"),
        ("3", "m", "x", 1, _t(9), Decimal("-1.0000"), 5, "FR", "p"),
        ("4", "DCGS0003", "box", 2, _t(9), Decimal("3.0000"), 5, "FR", "p"),
        (None, None, None, 0, _t(9), Decimal("1.0000"), None, None, "p"),
    ]
    s = layers.silver(_bronze(spark, rows), stockcode_categories(spark))
    got = {(r[S.INVOICE], r[S.STOCK_CODE]): r for r in s.collect()}
    assert len(s.collect()) == 6
    post = got[("C1", "POST")]
    assert post["is_cancellation"] and post["is_repeated_row"] and post["is_missing_customer"]
    assert post["line_category"] == "shipping" and post["raw_line_value"] == Decimal("-5.0000")
    assert got[("2", "M")]["line_category"] == "manual" and got[("2", "M")]["is_zero_price"]
    assert got[("3", "m")]["is_negative_price"]
    dcgs = got[("4", "DCGS0003")]
    assert dcgs["is_special_stockcode"] and dcgs["line_category"] == "product"
    nulls = got[(None, None)]
    assert nulls["is_cancellation"] is False and nulls["line_category"] == "product"
    assert not nulls["is_repeated_row"]


def test_order_dimension_ties_and_sale_rules(spark):
    rows = [
        ("B2", "10", "new text", 2, _t(10), Decimal("2.0000"), 7, "FR", "p"),
        ("A1", "10", "old text", 1, _t(10), Decimal("2.0000"), 7, "DE", "p"),
        ("C3", "10", "x", -1, _t(11), Decimal("2.0000"), 7, "DE", "p"),
        ("C3", "10", "x", 1, _t(11), Decimal("2.0000"), 7, "DE", "p"),
    ]
    s = layers.silver(_bronze(spark, rows), stockcode_categories(spark))
    fol = layers.fact_order_lines(s)
    fo = layers.fact_orders(fol)
    dc = layers.dim_customers(fo).collect()[0]
    # two orders at the same minute: the tie goes to the larger invoice text
    assert dc["is_multi_country"] and dc["distinct_countries"] == 2
    assert dc["latest_country"] == "DE"      # C3 is the latest order
    dp = layers.dim_products(fol).collect()[0]
    assert dp["product_description"] == "x" and dp["distinct_descriptions"] == 3
    c3 = fo.filter(F.col(S.INVOICE) == "C3").collect()[0]
    # a positive quantity on a C invoice is neither sale nor cancellation
    assert c3["has_product_cancellation"] and not c3["has_product_sale"]
    assert c3["net_product_sales_value"] == Decimal("-2.0000")


def test_rfm_scores_keep_non_positive_monetary(spark):
    rows = []
    for cust, n, price in [(1, 1, "10"), (2, 3, "50"), (3, 1, "0.5"), (4, 12, "100"), (5, 2, "1")]:
        for i in range(n):
            rows.append((f"{cust}{i}", "10", "t", 1, _t(9, i, d=1 + cust), Decimal(price), cust, "FR", "p"))
    # customer 3 also cancels more than it bought → monetary ≤ 0
    rows.append(("C39", "10", "t", -5, _t(12, 0, d=4), Decimal("0.5"), 3, "FR", "p"))
    s = layers.silver(_bronze(spark, rows), stockcode_categories(spark))
    fo = layers.fact_orders(layers.fact_order_lines(s))
    rfm = {r["customer_id"]: r for r in layers.customer_rfm(fo).collect()}
    assert set(rfm) == {1, 2, 3, 4, 5}
    assert rfm[3]["monetary"] == -2.0 and rfm[3]["m_score"] == 1
    assert rfm[4]["f_score"] == 5 and rfm[4]["frequency"] == 12
    assert all(1 <= r["r_score"] <= 5 and 1 <= r["m_score"] <= 5 for r in rfm.values())
    # last purchase day is 6 Jan (customer 5): reference = the day after
    assert rfm[4]["rfm_reference_date"] == dt.date(2011, 1, 7)
    assert rfm[5]["recency"] == 1 and rfm[1]["recency"] == 5


def test_invariants_on_the_supplied_tables(wh_check):
    fo = wh_check.table("fact_orders")
    bad = fo.filter(F.col("net_product_sales_value")
                    != F.col("gross_product_sales_value") + F.col("product_cancellation_value")).count()
    assert bad == 0
    lines = wh_check.table("fact_order_lines").agg(F.sum("net_product_sales_value")).collect()[0][0]
    orders = fo.agg(F.sum("net_product_sales_value")).collect()[0][0]
    assert lines == orders
    rfm = wh_check.table("customer_rfm")
    assert rfm.filter(~F.col("r_score").between(1, 5) | ~F.col("m_score").between(1, 5)).count() == 0
    purchasers = fo.filter(F.col("has_product_sale") & F.col("customer_id").isNotNull()) \
                   .select("customer_id").distinct().count()
    assert rfm.count() == purchasers
    from tillroll.plans.customers import segment_value
    shares = segment_value(wh_check).agg(F.sum("sales_share_pct")).collect()[0][0]
    assert abs(shares - 100.0) < 1e-9


def test_checks_all_pass(wh_check):
    from tillroll.plans import checks
    assert checks.check_bronze(wh_check).collect()[0]["bronze_is_valid"]
    assert checks.check_orders(wh_check).collect()[0]["grain_valid"]
    assert checks.check_customers(wh_check).collect()[0]["grain_valid"]
    assert checks.check_products(wh_check).collect()[0]["grain_valid"]
    assert checks.check_categories(wh_check).collect()[0]["missing_categories"] == 0
    from tillroll.plans.customers import check_rfm
    r = check_rfm(wh_check).collect()[0]
    assert r["grain_valid"] and r["scores_valid"] and r["recency_lt_0"] == 0 and r["frequency_le_0"] == 0


def test_monthly_rate_is_null_for_a_month_without_sales(spark):
    from tillroll.plans import sales
    rows = [("C1", "10", "t", -1, _t(9), Decimal("2.0"), 1, "FR", "p")]
    s = layers.silver(_bronze(spark, rows), stockcode_categories(spark))
    fo = layers.fact_orders(layers.fact_order_lines(s))

    class _W:
        def table(self, name):
            return fo
    r = sales.monthly_cancel_rate(_W()).collect()[0]
    assert r["cancellation_rate"] is None and r["gross_sales_m"] == 0.0


def test_price_series_text_is_stripped(spark):
    from tillroll.functions.numeric import strip
    df = spark.createDataFrame([("\t small ring \n",), ("small ring",), (None,)], "d string")
    assert [r[0] for r in df.select(strip("d")).collect()] == ["small ring", "small ring", None]


def test_pipeline_checks_pass_and_a_failure_stops_the_run(spark, wh_check, monkeypatch):
    import pytest
    from tillroll.plans import pipeline
    res = pipeline.run_checks(wh_check)
    assert res["check_orders"]["grain_valid"] and res["check_bronze"]["bronze_is_valid"]

    def broken(wh):
        return spark.createDataFrame([(False, 1)], "grain_valid boolean, orders long")
    monkeypatch.setitem(pipeline._RULES, "check_orders", (broken, ["grain_valid"], []))
    with pytest.raises(pipeline.CheckFailed, match="check_orders.grain_valid"):
        pipeline.run_checks(wh_check)
