"""Results do not depend on the session time zone or on ANSI mode."""

from __future__ import annotations

import pytest

from tillroll.oracle.compare import compare
from tillroll.plans.warehouse import Warehouse
from tillroll.registry import oracle_sql, output_edge, plan_functions

KEYS = ["ingest_consolidated", "fact_orders", "customer_rfm", "monthly_sales", "weekday_performance",
        "year_comparison", "audit_multi_timestamp"]


@pytest.fixture()
def other_settings(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_other_time_zone_and_non_ansi_give_the_same_results(other_settings, duck_check):
    from tests.conftest import SF_CHECK
    wh = Warehouse(other_settings, SF_CHECK, materialize=False)   # plans only, nothing stored
    sqls = oracle_sql()
    for key in KEYS:
        res = compare(output_edge(plan_functions()[key](wh)), sqls[key], duck_check)
        assert res["ok"], (key, res)
