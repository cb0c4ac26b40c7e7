"""Layer (1): the audit on hand-made lines — A invoices, mixed-customer
invoices, unclassified special codes, extreme quantities, unparseable dates."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from tillroll import schemas as S
from tillroll.plans import audit
from tillroll.sources.periods import read_period, type_period


class _Lines:
    """Just enough of a warehouse for the audit: the bronze table."""

    def __init__(self, spark, rows):
        self.spark = spark
        self._bronze = spark.createDataFrame(rows, S.BRONZE_SCHEMA)

    def table(self, name):
        assert name == "bronze"
        return self._bronze


def _t(h, m=0):
    return dt.datetime(2011, 3, 1, h, m)


ROWS = [
    ("A563185", "B", "Adjust bad debt", 1, _t(9), Decimal("11062.0600"), None, "UK", "p"),
    ("A563186", "B", "Adjust bad debt", 1, _t(9, 5), Decimal("-11062.0600"), None, "UK", "p"),
    ("C1", "POST", "POSTAGE", 5, _t(10), Decimal("18.0000"), 12, "FR", "p"),
    ("500", "ZZTOP", "mystery", -3, _t(11), Decimal("0.0000"), 12, "FR", "p"),
    ("500", "85123A", "heart", 80995, _t(11), Decimal("2.0800"), None, "FR", "p"),
    ("501", "85123A", "heart", -80995, _t(11, 9), Decimal("2.0800"), 13, "DE", "p"),
    ("501", None, None, 1, _t(11, 9), Decimal("1.0000"), 13, "DE", "p"),
]


def test_prefixes_and_a_invoices(spark):
    wh = _Lines(spark, ROWS)
    prefixes = {r["prefix"]: r["rows"] for r in audit.audit_invoice_prefix(wh).collect()}
    assert prefixes == {"A": 2, "C": 1, "NUMERIC": 4}
    assert [r[S.INVOICE] for r in audit.audit_a_invoices(wh).collect()] == ["A563185", "A563186"]


def test_mixed_invoices_and_missing_customer(spark):
    wh = _Lines(spark, ROWS)
    mixed = audit.audit_mixed_invoices(wh).collect()
    assert [(r[S.INVOICE], r["rows_without_customer"], r["rows_with_customer"]) for r in mixed] == [("500", 1, 1)]
    m = audit.audit_missing_customer(wh).collect()[0]
    assert m["missing_customer_rows"] == 3 and m["mixed_invoices"] == 1 and m["invoices"] == 3


def test_special_codes_and_classification(spark):
    wh = _Lines(spark, ROWS)
    inv = {r[S.STOCK_CODE]: r for r in audit.audit_special_codes(wh).collect()}
    # the null code is special (no leading digit) but not a group of the inventory
    assert set(inv) == {"B", "POST", "ZZTOP"}
    assert inv["B"]["rows"] == 2 and inv["B"][S.DESCRIPTION] == "Adjust bad debt" and inv["B"]["description_rows"] == 2
    classes = {r["stock_code"]: r["category"] for r in audit.audit_classification(wh).collect()}
    assert classes == {"B": "adjustment", "POST": "shipping", "ZZTOP": "stock_movement"}
    unknown = audit.audit_unclassified_codes(wh).collect()
    assert [r[S.STOCK_CODE] for r in unknown] == ["ZZTOP"]
    counts = {r["category"]: (r["codes_by_rules"], r["codes_final"]) for r in audit.audit_category_counts(wh).collect()}
    assert counts["unknown"] == (1, None) and counts["stock_movement"] == (None, 1)


def test_extreme_quantity_keeps_both_signs_and_positive_cancellations(spark):
    wh = _Lines(spark, ROWS)
    ext = audit.audit_extreme_quantity(wh).collect()
    assert sorted(r[S.QUANTITY] for r in ext) == [-80995, 80995]
    pos_c = audit.audit_positive_cancellations(wh).collect()
    assert [r[S.INVOICE] for r in pos_c] == ["C1"]
    signs = audit.audit_quantity_signs(wh).collect()[0]
    assert signs["negative_rows"] == 2 and signs["negative_on_c_rows"] == 0 and signs["c_positive_quantity"] == 1


def test_multi_timestamp_invoice(spark):
    wh = _Lines(spark, ROWS)
    rows = audit.audit_multi_timestamp(wh).collect()
    assert len(rows) == 0   # each invoice here has one timestamp
    extra = ROWS + [("500", "85123A", "heart", 1, _t(11, 2), Decimal("2.0800"), None, "FR", "p")]
    r = audit.audit_multi_timestamp(_Lines(spark, extra)).collect()[0]
    assert (r[S.INVOICE], r["gap_minutes"], r["same_day"], r["rows"]) == ("500", 2.0, True, 3)


def test_unparseable_date_fails_the_ingest(spark):
    d = tempfile.mkdtemp(prefix="tillroll-test-")
    path = os.path.join(d, "p.csv")
    with open(path, "w") as fh:
        fh.write(",".join(S.RAW_COLUMNS) + "\n")
        fh.write("1,10,x,1,not a date,1.0,1,FR\n")
    with pytest.raises(Exception):
        type_period(read_period(spark, path, "csv"), "p").collect()
