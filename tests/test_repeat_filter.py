"""Suspects of the two-bit counts hold every repeated row; lines in buckets of invoices
are grouped where they lie."""

from __future__ import annotations

import os
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll import schemas as S
from tillroll import session
from tillroll.operators.repeat_filter import repeat_filter
from tillroll.plans import audit, checks, layers
from tillroll.plans import warehouse as W


@pytest.mark.parametrize("cells", [64, 1 << 28])
def test_every_repeated_row_is_a_suspect(spark, cells):
    rnd = random.Random(cells)
    rows = [(rnd.choice([None, "a", "b", "cé"]), rnd.choice([None, *range(40)]), i % 7) for i in range(500)]
    rows += [(f"u{i}", i, 0) for i in range(6000)] + [("hot", 1, 1)] * 3000 + [(None, None, 1), (None, None, 2)]
    df = spark.createDataFrame(rows, "k string, x long, other int").repartition(7)
    f = repeat_filter(df, ["k", "x"], most_cells=cells)
    got = [tuple(r) for r in df.where(f.suspect()).collect()]
    count = Counter(r[:2] for r in rows)
    want = sorted((r for r in rows if count[r[:2]] > 1), key=str)
    assert set(want) <= set(got) and sorted((r for r in got if count[r[:2]] > 1), key=str) == want
    if cells > 64:  # nearly nothing but repeats
        assert len(got) - len(want) < 0.05 * 6000
    assert len(got) + df.where(~f.suspect()).count() == len(rows)


def test_empty_table_has_no_suspect(spark):
    df = spark.createDataFrame([], "k string")
    assert df.where(repeat_filter(df, ["k"]).suspect()).count() == 0


def _fresh(spark, **kw):
    wh = W.Warehouse(spark, SF_SMALL, root=os.path.join(session.checkpoint_dir(spark), "tillroll-test", uuid.uuid4().hex))
    for k, v in kw.items():
        setattr(wh, k, v)
    return wh


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line]


def test_only_suspects_are_shuffled_for_the_repeat_flag(spark):
    wh = _fresh(spark)
    bronze, suspects = wh.table("bronze").count(), wh.repeat_suspects().count()
    assert suspects < 0.1 * bronze
    plan = layers.silver(wh.table("bronze"), wh.categories(), (wh._split_bronze()[0], wh.repeat_suspects()))
    flagged = plan.where("is_repeated_row")
    brute = wh.table("bronze").groupBy(*S.BRONZE_COLUMNS).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.sum("n")).first()[0]
    assert flagged.count() == brute > 0 and plan.count() == bronze
    # each exchange stands above the suspects' own scan
    assert all("bronze" not in part.split("FileScan", 1)[1].splitlines()[0] for part in
               plan._jdf.queryExecution().executedPlan().toString().split("Exchange")[1:] if "FileScan" in part)


def test_invoice_reports_move_no_line(spark):
    wh = _fresh(spark)
    assert wh.by_invoice(layers.fact_orders).count() == wh.table("fact_orders").count()
    assert not _exchanges(wh.by_invoice(layers.fact_orders))
    assert all("SinglePartition" in e for e in _exchanges(audit.audit_invoice_grain(wh)))
    assert not [e for e in _exchanges(audit.audit_multi_timestamp(wh)) if "hashpartitioning" in e]
    assert not [e for e in _exchanges(audit.audit_mixed_invoices(wh)) if "hashpartitioning" in e]


def test_large_invoices_lie_apart_and_results_are_the_same(spark):
    plain, apart = _fresh(spark), _fresh(spark, HOT_SHARE=100)
    results = []
    for wh in (plain, apart):
        wh.table("fact_orders")
        results.append([sorted(map(str, df.collect())) for df in (
            wh.table("fact_order_lines"), wh.table("fact_orders"), audit.audit_invoice_grain(wh), audit.audit_mixed_invoices(wh),
            audit.audit_multi_timestamp(wh), audit.audit_missing_customer(wh), checks.check_orders(wh),
            checks.check_order_lines(wh), checks.check_stored_metrics(wh))])
    assert len(plain._parts["fact_order_lines"]) == 1 and len(apart._parts["fact_order_lines"]) == 2
    hot, rest = (p.select("Invoice").distinct() for p in reversed(apart._parts["fact_order_lines"]))
    assert hot.count() > 0 and hot.join(rest, "Invoice").count() == 0
    assert results[0] == results[1]


def test_a_session_without_the_catalog_table_makes_it_again(spark):
    first = _fresh(spark, HOT_SHARE=100)
    rows = sorted(map(str, first.table("fact_order_lines").collect()))
    path = session.read_pointer(spark, os.path.join(first.root, "fact_order_lines.current"))
    spark.sql(f"DROP TABLE {W._catalog_name(path)}")  # an external table: its files stay
    again = W.Warehouse(spark, SF_SMALL, root=first.root)
    assert sorted(map(str, again.table("fact_order_lines").collect())) == rows
    assert not [e for e in _exchanges(layers.fact_orders(again._parts["fact_order_lines"][0])) if "hashpartitioning" in e]


def test_metrics_of_another_table_are_seen(spark):
    wh = _fresh(spark)
    assert all(r["metrics_match"] for r in checks.check_stored_metrics(wh).collect())
    assert checks.check_bronze(wh).first()["bronze_is_valid"]
    # the stored table is replaced by one that lacks a line
    wh._tables["bronze"] = wh.table("bronze").limit(wh.table("bronze").count() - 1)
    assert {r["table"] for r in checks.check_stored_metrics(wh).where("not metrics_match").collect()} == {"bronze"}
    assert not checks.check_bronze(wh).first()["bronze_is_valid"]


def test_buckets_and_join_tasks_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 300)
    wh = _fresh(spark)
    lines, sources = wh.table("fact_order_lines").count(), spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    buckets = max(8, -(-lines // 300))
    assert buckets > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.read_pointer(spark, os.path.join(wh.root, "fact_order_lines.current")).endswith(f"-b{buckets}")
    plan = wh._compute("landing")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey#" in plan and plan.count(f", {-(-sources // 300)}), REPARTITION_BY_NUM") >= 2
    # what moves is what the other columns follow from
    silver = wh.table("silver_transactions")
    again = layers.with_flags(silver.select(*layers.SEED_COLUMNS))
    assert again.columns == silver.columns and again.exceptAll(silver).count() == silver.exceptAll(again).count() == 0


def test_counts_are_sent_as_bytes_and_chunks_agree(spark, monkeypatch):
    from tillroll.operators import repeat_filter as R
    df = spark.range(5000).selectExpr("id % 4000 as x").repartition(2)
    whole = R.repeat_filter(df, ["x"])
    monkeypatch.setattr(R, "HELD", 100)
    parts = R.repeat_filter(df, ["x"])
    assert isinstance(whole.cells.value, bytes) and parts.cells.value == whole.cells.value
    assert df.where(parts.suspect()).select("x").distinct().count() >= 1000


def test_order_values_follow_from_fewer_sums(wh_check):
    lines = wh_check.table("fact_order_lines")
    orders = layers.fact_orders(lines)
    assert "sum(net_product_sales_value" not in orders._jdf.queryExecution().optimizedPlan().toString()
    plain = lines.groupBy("Invoice").agg(F.sum("net_product_sales_value").cast("decimal(38,4)"), F.bool_or("is_product_sale"), F.bool_or("is_product_cancellation"))
    got = orders.select("Invoice", "net_product_sales_value", "has_product_sale", "has_product_cancellation")
    assert [f.dataType for f in got.schema] == [f.dataType for f in plain.schema]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, plain.collect())))
