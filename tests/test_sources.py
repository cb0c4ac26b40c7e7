"""Layer (1): hand-made rows for the source boundary (typing, consolidation,
CSV/Parquet round trips) — the cases the test-table mapping cannot produce."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.sources.periods import bronze_summary, consolidate, ingest, read_period, type_period
from tillroll.sources.reference import (STOCKCODE_CATEGORIES, audit_rule_map, read_stockcode_categories,
                                        stockcode_categories, write_stockcode_categories)

HEADER = ",".join(S.RAW_COLUMNS)


def _csv(rows):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    path = os.path.join(d, "period.csv")
    with open(path, "w") as fh:
        fh.write(HEADER + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")
    return path


def test_category_table_is_the_fixed_62_codes():
    assert len(STOCKCODE_CATEGORIES) == 62
    counts = {}
    for _, c in STOCKCODE_CATEGORIES:
        counts[c] = counts.get(c, 0) + 1
    assert counts == {"stock_movement": 20, "product": 18, "gift_voucher": 9, "adjustment": 3, "fee": 3,
                      "shipping": 3, "manual": 2, "test": 2, "discount": 1, "sample": 1}
    # the rule lists agree with the table for every code they name
    table = dict(STOCKCODE_CATEGORIES)
    assert all(table[code] == cat for code, cat in audit_rule_map())


def test_category_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    write_stockcode_categories(stockcode_categories(spark), d)
    back = read_stockcode_categories(spark, d)
    assert sorted(map(tuple, back.collect())) == sorted(STOCKCODE_CATEGORIES)


def test_typing_is_lenient_for_ids_and_strict_elsewhere(spark):
    path = _csv([
        ["536365", "85123A", "WHITE HANGING HEART", "6", "2010-12-01 08:26:00", "2.55", "17850.0", "United Kingdom"],
        ["A563185", "B", "Adjust bad debt", "1", "2011-08-12 14:50:00", "11062.06", "", "United Kingdom"],
        ["C536379", "D", "\tDiscount ", "-1", "2010-12-01 09:41:00", "27.50", "abc", "United Kingdom"],
    ])
    typed = type_period(read_period(spark, path, "csv"), "2009-2010")
    rows = typed.orderBy(S.INVOICE).collect()
    assert [r[S.CUSTOMER] for r in rows] == [17850, None, None]
    assert rows[0][S.PRICE] == Decimal("2.5500")
    assert rows[0][S.INVOICE_DATE] == dt.datetime(2010, 12, 1, 8, 26)
    assert rows[2][S.QUANTITY] == -1
    assert typed.schema[S.INVOICE_DATE].dataType.simpleString() == "timestamp_ntz"
    assert set(r[S.PERIOD] for r in rows) == {"2009-2010"}

    bad = _csv([["1", "X", "x", "three", "2010-12-01 08:26:00", "1.0", "1", "FR"]])
    with pytest.raises(Exception):
        type_period(read_period(spark, bad, "csv"), "p").collect()


def test_overlap_is_kept_from_the_later_period(spark):
    early = _csv([
        ["1", "10", "a", "1", "2010-11-30 10:00:00", "1.0", "1", "FR"],
        ["2", "10", "a", "1", "2010-12-02 10:00:00", "1.0", "1", "FR"],
    ])
    late = _csv([
        ["2", "10", "a", "1", "2010-12-02 10:00:00", "1.0", "1", "FR"],
        ["3", "10", "a", "1", "2011-01-05 10:00:00", "1.0", "1", "FR"],
    ])
    bronze = ingest(read_period(spark, early, "csv"), read_period(spark, late, "csv"),
                    "2009-2010", "2010-2011", "2010-12-01 00:00:00")
    got = sorted((r[S.INVOICE], r[S.PERIOD]) for r in bronze.collect())
    assert got == [("1", "2009-2010"), ("2", "2010-2011"), ("3", "2010-2011")]
    s = bronze_summary(bronze).collect()[0]
    assert (s["row_count"], s["column_count"]) == (3, 9)


def test_parquet_round_trip_of_bronze(spark):
    early = _csv([["1", "10", "a", "2", "2010-11-30 10:00:00", "1.5", "7", "FR"]])
    bronze = consolidate(type_period(read_period(spark, early, "csv"), "p1"),
                         type_period(read_period(spark, early, "csv").limit(0), "p2"), "2010-12-01 00:00:00")
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    bronze.write.mode("overwrite").parquet(d)
    back = read_period(spark, d, "parquet")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in bronze.schema]
    assert back.collect() == bronze.collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("column, value", [(3, "two"), (3, "2.5"), (4, "yesterday"), (5, "cheap"), (5, "0.00004")])
def test_values_that_cannot_be_read_stop_the_job(spark, ansi, column, value):
    row = ["1", "10", "a", "2", "2010-11-30 10:00:00", "1.5", "7", "FR"]
    row[column] = value
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="can't be read"):
            type_period(read_period(spark, _csv([row]), "csv"), "p").collect()
        fine = type_period(read_period(spark, _csv([["1", "10", "a", "2.0", "2010-11-30 10:00:00", "0.0042", "x", "FR"]]), "csv"), "p")
        assert fine.select(S.QUANTITY, S.PRICE, S.CUSTOMER).collect() == [(2, Decimal("0.0042"), None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_every_extract_is_written_with_a_header(spark, wh_check):
    from tillroll.plans.exports import EXTRACTS, write_extracts
    paths = write_extracts(wh_check, tempfile.mkdtemp(prefix="tillroll-test-"))
    assert len(paths) == len(EXTRACTS) == 4
    back = spark.read.option("header", True).csv(paths["stockcode_categories"])
    assert back.columns == ["stock_code", "category"]
    assert {tuple(r) for r in back.collect()} >= {("POST", "shipping"), ("GIFT", "stock_movement")}


def test_extract_csv_has_header_and_order(spark, wh_check):
    from tillroll.plans.exports import write_csv, export_orders
    d = os.path.join(tempfile.mkdtemp(prefix="tillroll-test-"), "orders")
    write_csv(export_orders(wh_check), d)
    back = spark.read.option("header", True).csv(d)
    assert back.columns[:3] == ["invoice", "order_datetime", "customer_id"]
    assert back.count() == wh_check.table("fact_orders").count()


def test_fixture_totals_match_the_documented_values(wh_check):
    b = wh_check.table("bronze")
    row = b.agg(F.count(F.lit(1)).alias("n"), F.sum(S.QUANTITY).alias("q"),
                F.sum(F.col(S.QUANTITY) * F.col(S.PRICE)).alias("v"),
                F.countDistinct(S.INVOICE).alias("inv"), F.countDistinct(S.CUSTOMER).alias("cust")).collect()[0]
    assert (row["n"], row["q"], row["inv"], row["cust"]) == (60753, 488200, 25040, 1497)
    assert row["v"] == Decimal("486989520.6000")
