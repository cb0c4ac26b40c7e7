"""Mergeable summaries against plain counts: quantile cells, frequent values, first rows of
several lists, multiset fingerprints; and bound statement parameters."""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import heavy_values, quantile_sketch
from tillroll.operators.multiset import compare_multisets
from tillroll.operators.top_lists import TopList, top_lists
from tillroll.operators.topk import top_values
from tillroll.plans import audit, sales, scope


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- quantile sketch --

def test_sketches_of_parts_add_up_and_keep_their_bounds(spark):
    rnd = random.Random(1)
    values = [round(rnd.lognormvariate(2, 2), 4) * rnd.choice([1, 1, 1, -1]) for _ in range(5000)] + [0.0, 0.0001, -0.0001, 9e9]
    df = spark.createDataFrame([(Decimal(str(v)).quantize(Decimal("0.0001")), i % 3) for i, v in enumerate(values)] + [(None, 1)],
                               "x decimal(18,4), part int")
    parts = quantile_sketch.sketch(df, "x", 4, [F.col("part")])
    whole = quantile_sketch.sketch(df, "x", 4)
    key = lambda d: sorted(tuple(r) for r in d.select("low", "width", "n").collect())
    assert key(quantile_sketch.merged(parts)) == key(whole) and len(key(whole)) < 3000
    units = sorted(int(Decimal(str(v)).quantize(Decimal("0.0001")).scaleb(4)) for v in values)
    for low, width, n in key(whole):
        inside = range(low, low + width) if low >= 0 else range(low - width + 1, low + 1)
        assert n == sum(1 for u in units if u in inside) and (width == 1 or width * 2 ** quantile_sketch.BITS <= abs(low))
    qs = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
    got = quantile_sketch.approx_quantiles(whole, qs, 4).collect()
    assert {r["quantile"] for r in got} == set(qs)
    for r in got:
        at = int((len(units) - 1) * r["quantile"])
        assert r["low"] <= units[at] / 1e4 <= r["high"] and r["low"] <= r["value"] <= r["high"]
        below, upto = sum(u / 1e4 < r["value"] for u in units), sum(u / 1e4 <= r["value"] for u in units)
        assert max(below - at, at - max(upto - 1, below), 0) / len(units) <= r["rank_bound"]
    assert quantile_sketch.approx_quantiles(quantile_sketch.sketch(df.limit(0), "x", 4), qs, 4).count() == 0


def test_approximate_prices_stay_within_their_bounds(wh_check):
    rows = audit.price_quantiles_approx(wh_check).collect()
    assert len(rows) == len(audit.PRICE_QUANTILES) and all(r["within_bound"] for r in rows)
    assert all(abs(r["value"] - r["exact_value"]) <= 0.02 * r["exact_value"] for r in rows)


# ------------------------------------------------------------- frequent values --

@pytest.mark.parametrize("counters", [8, 50, 1 << 14])
def test_frequent_values_lose_none(spark, counters):
    rnd = random.Random(counters)
    rows = [(rnd.choice(["a", "b", None, "c", "d"]),) for _ in range(4000)] + [(f"v{rnd.randint(0, 3000)}",) for _ in range(6000)]
    rows += [("tie1",), ("tie2",)] * 700
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "v string").repartition(5)
    for n in (1, 3, 6, 20):
        want = [tuple(r) for r in top_values(df, "v", n).orderBy("rank").collect()]
        assert [tuple(r) for r in heavy_values.top_heavy_values(df, "v", n, counters=counters).orderBy("rank").collect()] == want
    found = heavy_values.summary(df, "v", counters).collect()
    error, counts, true = sum(r["taken"] or 0 for r in found), Counter(), Counter(v for v, in rows)
    for r in found:
        if r["taken"] is None:
            counts[r["value"]] += r["n"]
    assert all(counts[v] <= true[v] <= counts[v] + error for v in true) and (error > 0) == (counters < 1000)
    assert heavy_values.top_heavy_values(df.limit(0), "v", 3).count() == 0


# ------------------------------------------------------------------- top lists --

def test_several_lists_in_one_read(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, *range(30)]), rnd.choice([None, "x", "y", "é"]), Decimal(i) / 100, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b string, c decimal(9,2), id long").repartition(6)
    lists = [TopList("small", F.col("b") == "x", (("a", True), ("b", False), ("id", True)), 40),
             TopList("large", F.lit(True), (("c", False), ("id", True)), 7), TopList("none", F.col("a") > 99, (("id", True),), 3)]
    out = top_lists(df, lists, ["a", "b", "id"])
    got = {n: [tuple(r)[2:] for r in out.where(F.col("list_name") == n).orderBy("rank").collect()] for n in ("small", "large", "none")}
    first = lambda v: (v is not None, v)
    assert got["small"] == [(a, b, i) for a, b, _, i in sorted((r for r in rows if r[1] == "x"), key=lambda r: (first(r[0]), r[3]))][:40]
    assert got["large"] == [(a, b, i) for a, b, _, i in sorted(rows, key=lambda r: -r[3])][:7] and got["none"] == []
    assert top_lists(df.limit(0), lists, ["id"]).count() == 0


def test_examples_read_the_lines_once_and_sort_nothing(wh_check):
    plan = _plan(scope.line_type_examples(wh_check))
    assert plan.count("FileScan") == 1 and "Sort" not in plan and "TakeOrdered" not in plan
    wh_check.derived("order_lists", scope._compute_order_lists)
    assert _plan(scope._compute_order_lists(wh_check)).count("FileScan") == 1


# ---------------------------------------------------------- multiset comparison --

def test_only_rows_of_differing_keys_are_compared(spark):
    rnd = random.Random(6)
    rows = [(rnd.randrange(200), rnd.choice(["p", None]), rnd.choice([1, 2, None])) for _ in range(3000)]
    a = spark.createDataFrame(rows, "k long, s string, x long")
    same = spark.createDataFrame(rnd.sample(rows, len(rows)), a.schema)
    keys, apart = compare_multisets(a, same, ["k", "s", "x"], ["k"])
    assert keys.where("not balanced").count() == 0 and apart.count() == 0
    # nulls in other places, one row changed, one copy more
    for change in (lambda r: (r[0], None if r[1] else "p", r[2]), lambda r: (r[0], r[1], 7), lambda r: (None, r[1], r[2])):
        other = [change(rows[0]), *rows[1:]]
        keys, apart = compare_multisets(a, spark.createDataFrame(other, a.schema), ["k", "s", "x"], ["k"])
        ca, cb = Counter(rows), Counter(other)
        got = {tuple(r)[:3]: (r["rows_a"], r["rows_b"]) for r in apart.collect()}
        differ = {rows[0][0], change(rows[0])[0]}
        assert {r["k"] for r in keys.where("not balanced").collect()} == differ
        assert got == {r: (ca[r], cb[r]) for r in set(ca) | set(cb) if r[0] in differ}


def test_overlap_report_sees_one_changed_row(spark, wh_check):
    class Changed:
        def raw_periods(self):
            early, late = wh_check.raw_periods()
            days = late.where(F.col("InvoiceDate").between(F.lit(audit.FM.OVERLAP_START).cast("timestamp_ntz"),
                                                           F.lit(audit.FM.OVERLAP_END).cast("timestamp_ntz")))
            first = days.agg(F.min("Invoice").alias("_first"))
            return early, late.crossJoin(F.broadcast(first)).withColumn(
                "Description", F.when(F.col("Invoice") == F.col("_first"), "changed").otherwise(F.col("Description"))).drop("_first")

    same, one = audit.audit_overlap(wh_check).first(), audit.audit_overlap(Changed()).first()
    assert same["identical_rows"] and (same["only_in_a"], same["only_in_b"]) == (0, 0)
    assert not one["identical_rows"] and one["same_row_count"] and one["only_in_a"] == one["only_in_b"] > 0
    assert one["rows_a"] == same["rows_a"] and one["common_invoices"] == same["common_invoices"]


# ------------------------------------------------------------ bound parameters --

def test_a_parameter_is_compared_and_never_parsed(wh_check):
    assert sales.product_by_country(wh_check).count() > 0
    for text in ("EIRE' OR '1' = '1", "EIRE; DROP TABLE x", ":country", "' UNION SELECT * FROM lines --", ""):
        assert sales.product_by_country(wh_check, text).count() == 0
    assert "EIRE" in _plan(sales.product_by_country(wh_check)) and "PushedFilters" in _plan(sales.product_by_country(wh_check))
