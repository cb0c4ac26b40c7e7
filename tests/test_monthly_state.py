"""Monthly totals by batches equal a full run; a batch rewrites its months only, once."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid
from decimal import Decimal

from tillroll import schemas as S
from tillroll import session
from tillroll.plans import layers
from tillroll.plans.sales import monthly_totals
from tillroll.sources.reference import stockcode_categories
from tillroll.streaming.ingest import ingest_stream
from tillroll.streaming.monthly import MonthlyTotals, start_monthly_totals


def _rows(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        invoice = rnd.choice(["", "C"]) + str(rnd.randint(1, n // 4))
        rows.append((invoice, rnd.choice(["20001", "POST", "20002"]), "t", rnd.choice([1, 2, -1]),
                     dt.datetime(2011, rnd.randint(1, 6), rnd.randint(1, 28), 9), Decimal(rnd.randint(0, 900)) / 100,
                     rnd.choice([None, 7, 8, 9]), "UK", "p"))
    return rows


def _state(spark, folder=None):
    folder = folder or os.path.join(session.checkpoint_dir(spark), "tillroll-test", uuid.uuid4().hex)
    return MonthlyTotals(spark, folder, stockcode_categories(spark))


def _full(spark, rows):
    lines = layers.fact_order_lines(layers.silver(spark.createDataFrame(rows, S.BRONZE_SCHEMA), stockcode_categories(spark)))
    return sorted(tuple(r) for r in monthly_totals(layers.fact_orders(lines)).collect())


def _totals(state):
    df = state.totals()
    return sorted(tuple(r) for r in df.collect())


def test_batches_equal_a_full_run(spark):
    state, seen = _state(spark), []
    for batch in range(3):
        rows = _rows(300, batch)
        seen += rows
        state.apply(spark.createDataFrame(rows, S.BRONZE_SCHEMA), batch)
        assert _totals(state) == _full(spark, seen)
    assert state.drop_unused() and _totals(state) == _full(spark, seen)


def test_a_batch_rewrites_its_months_only_and_once(spark):
    line = lambda inv, month, q=1: (inv, "20001", "t", q, dt.datetime(2011, month, 5, 9), Decimal("2.0000"), 1, "UK", "p")
    state = _state(spark)
    first = [line("1", 1), line("2", 2), line("3", 3), line("4", 5)]
    assert state.apply(spark.createDataFrame(first, S.BRONZE_SCHEMA), 0) == ["2011-01-01", "2011-02-01", "2011-03-01", "2011-05-01"]
    before = state.manifest()["months"]
    # a further line of invoice 3; an earlier line of invoice 4 moves it from May to April
    second = [line("3", 3, 5), line("4", 4)]
    assert state.apply(spark.createDataFrame(second, S.BRONZE_SCHEMA), 1) == ["2011-03-01", "2011-04-01", "2011-05-01"]
    after = state.manifest()["months"]
    assert {m: after[m] for m in ("2011-01-01", "2011-02-01")} == {m: before[m] for m in ("2011-01-01", "2011-02-01")}
    assert after["2011-03-01"] != before["2011-03-01"] and "2011-05-01" not in after
    assert _totals(state) == _full(spark, first + second)
    # the same batch again, as after a failure
    assert state.apply(spark.createDataFrame(second, S.BRONZE_SCHEMA), 1) == [] and state.manifest()["months"] == after
    # another reader of the folder
    assert _totals(_state(spark, state.folder)) == _full(spark, first + second)


def test_stream_of_files_keeps_totals(spark, tmp_path):
    def write(folder, name, rows):
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join([",".join(S.RAW_COLUMNS), *(",".join(r) for r in rows)]) + "\n")

    early, late, check = (str(tmp_path / x) for x in ("early", "late", "check"))
    write(early, "a.csv", [["1", "10", "a", "1", "2010-11-30 10:00:00", "1.0", "1", "FR"]])
    write(late, "b.csv", [["3", "10", "a", "2", "2011-01-05 10:00:00", "1.5", "3", "FR"]])
    state = _state(spark)
    run = lambda: start_monthly_totals(ingest_stream(spark, early, late, "p1", "p2", "2010-12-01 00:00:00"), state, check).awaitTermination(120)
    run()
    assert [float(r["_net"]) for r in state.totals().orderBy("month").collect()] == [1.0, 3.0]
    old = state.manifest()["months"]
    write(late, "c.csv", [["4", "10", "a", "2", "2011-01-07 10:00:00", "1.0", "", "FR"], ["C5", "10", "a", "-1", "2011-01-08 10:00:00", "1.0", "3", "FR"]])
    run()
    assert [float(r["_net"]) for r in state.totals().orderBy("month").collect()] == [1.0, 4.0]
    assert state.manifest()["months"]["2010-11-01"] == old["2010-11-01"]
