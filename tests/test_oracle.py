"""Layer (2) of the test strategy: every registered query against its DuckDB
oracle on the supplied sf0.01 tables."""

from __future__ import annotations

import pytest

from tillroll.oracle.compare import compare
from tillroll.registry import NO_ORACLE, oracle_sql, output_edge, plan_functions

KEYS = sorted(plan_functions())
SQL = oracle_sql()


def test_every_key_has_an_oracle_or_is_declared_rows_only():
    assert set(KEYS) == set(SQL) | NO_ORACLE


@pytest.mark.parametrize("key", [k for k in KEYS if k in SQL])
def test_query_matches_oracle(key, wh_check, duck_check):
    df = output_edge(plan_functions()[key](wh_check))
    res = compare(df, SQL[key], duck_check)
    assert res["ok"], res


def test_table_columns_lists_the_fact_columns(wh_check):
    from tillroll.plans.tables import table_columns
    rows = table_columns(wh_check).collect()
    assert len(rows) == 24
    assert rows[0]["column_name"] == "Invoice"
    assert dict((r["column_name"], r["column_type"]) for r in rows)["net_product_sales_value"] == "decimal(38,4)"


def test_keys_that_showed_no_rows_before_have_some(wh_check):
    for key in ("audit_a_invoices", "audit_high_price_values", "audit_mixed_invoices", "audit_unclassified_codes"):
        assert plan_functions()[key](wh_check).count() > 0, key
    for key in ("audit_top_descriptions", "audit_duplicate_sizes"):
        assert plan_functions()[key](wh_check).count() > 1, key


def test_top_keys_take_ordered_rows(wh_check):
    for key in ("top_country_performance", "top_product_ranking", "top_product_cancellations"):
        plan = plan_functions()[key](wh_check)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan, key


def test_year_comparison_reads_only_its_months(wh_check):
    plan = plan_functions()["year_comparison"](wh_check)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_rollups_do_not_sort_lines(wh_check):
    from tillroll.plans import layers
    plan = layers.dim_products(wh_check.table("fact_order_lines"))._jdf.queryExecution().executedPlan().toString()
    before_first_exchange = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "Sort" not in before_first_exchange and "HashAggregate" in before_first_exchange
    # an invoice's lines lie in one bucket: no exchange, and the lines are hashed before anything is sorted
    plan = wh_check.by_invoice(layers.fact_orders)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "HashAggregate" in plan[plan.rindex("Sort ["):]
