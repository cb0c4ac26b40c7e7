"""End-to-end on a hand-made skewed input: one invoice holds a third of the
lines (all identical), one customer holds half of the orders.  The layers take
the one path they have at any size, and the result is compared with a pandas
brute force."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pandas as pd

from tillroll import schemas as S
from tillroll.plans import layers
from tillroll.sources.reference import stockcode_categories


def _rows():
    rnd = random.Random(3)
    rows = []
    # hot invoice: 1000 identical lines
    rows += [("H1", "20001", "hot item", 2, dt.datetime(2011, 5, 1, 10), Decimal("3.5000"), 7, "UK", "p")] * 1000
    # hot customer 7: many small orders
    for i in range(900):
        rows.append((f"7{i:04d}", f"2{rnd.randint(1, 40):04d}", "x", rnd.randint(1, 5),
                     dt.datetime(2011, 1 + i % 12, 1 + i % 27, 9), Decimal(rnd.randint(1, 900)) / 100, 7, "UK", "p"))
    # other customers, some cancellations and missing ids
    for i in range(1100):
        cust = None if i % 9 == 0 else 100 + i % 60
        inv = ("C" if i % 13 == 0 else "") + f"9{i:04d}"
        qty = -rnd.randint(1, 3) if inv.startswith("C") else rnd.randint(1, 3)
        rows.append((inv, f"2{rnd.randint(1, 40):04d}", "y", qty, dt.datetime(2010, 1 + i % 12, 1 + i % 28, 11),
                     Decimal(rnd.randint(1, 5000)) / 100, cust, "FR" if i % 2 else "DE", "p"))
    return rows


def test_skewed_layers_match_pandas(spark):
    rows = _rows()
    bronze = spark.createDataFrame(rows, S.BRONZE_SCHEMA).repartition(6)
    silver = layers.silver(bronze, stockcode_categories(spark))
    got_rep = silver.groupBy("is_repeated_row").count().collect()
    pdf = pd.DataFrame(rows, columns=S.BRONZE_COLUMNS)
    dup = pdf.astype(str).duplicated(keep=False)
    assert {r["is_repeated_row"]: r["count"] for r in got_rep} == dup.value_counts().to_dict()
    assert silver.count() == len(rows)

    fo = layers.fact_orders(layers.fact_order_lines(silver))
    hot = fo.filter("Invoice = 'H1'").collect()[0]
    assert hot["line_count"] == 1000 and hot["distinct_stockcodes"] == 1
    assert hot["gross_product_sales_value"] == Decimal("7000.0000")

    rfm = layers.customer_rfm(fo).toPandas().set_index("customer_id").sort_index()
    # brute force: pandas on the order grain
    pdf["value"] = pdf[S.QUANTITY].astype(float) * pdf[S.PRICE].astype(float)
    sale = (~pdf[S.INVOICE].str.startswith("C")) & (pdf[S.QUANTITY] > 0) & (pdf[S.PRICE].astype(float) > 0)
    cancel = pdf[S.INVOICE].str.startswith("C") & (pdf[S.QUANTITY] < 0) & (pdf[S.PRICE].astype(float) > 0)
    pdf["net"] = pdf["value"].where(sale | cancel, 0.0)
    pdf["sale"] = sale
    orders = pdf.groupby(S.INVOICE).agg(cust=(S.CUSTOMER, "max"), ts=(S.INVOICE_DATE, "min"),
                                        net=("net", "sum"), has_sale=("sale", "any"))
    orders = orders[orders["cust"].notna()]
    ref = orders[orders["has_sale"]]["ts"].max().normalize() + pd.Timedelta(days=1)
    cust = orders.groupby("cust").agg(freq=("has_sale", "sum"), monetary=("net", "sum"),
                                      last=("ts", lambda s: s[orders.loc[s.index, "has_sale"]].max()))
    cust = cust[cust["freq"] > 0]
    cust["monetary"] = cust["monetary"].round(2)
    cust["recency"] = (ref - cust["last"].dt.normalize()).dt.days
    r = pd.cut(cust["recency"].rank(method="average", pct=True), [0, .2, .4, .6, .8, 1.0],
               labels=[5, 4, 3, 2, 1], include_lowest=True).astype(int)
    m = pd.cut(cust["monetary"].rank(method="average", pct=True), [0, .2, .4, .6, .8, 1.0],
               labels=[1, 2, 3, 4, 5], include_lowest=True).astype(int)
    assert list(rfm.index) == [int(c) for c in cust.index]
    assert list(rfm["r_score"]) == list(r) and list(rfm["m_score"]) == list(m)
    assert list(rfm["frequency"]) == [int(f) for f in cust["freq"]]
    assert int(rfm.loc[7, "frequency"]) == 901    # the hot customer: H1 + 900 orders
