"""Distributed operators against brute force on small fixtures: the same single path
that large inputs take, here over the session's shuffle partitions."""

from __future__ import annotations

import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.functions.scoring import quintile_from_bounds
from tillroll.operators.quantiles import describe, equal_width_histogram, exact_quantiles, tail_histogram
from tillroll.operators.ranks import Key, range_partitioned, running_totals, value_ranks, with_score
from tillroll.operators.repeats import with_repeat_count
from tillroll.operators.topk import top_values


def _values(n, seed=7, distinct=40):
    rnd = random.Random(seed)
    # a hot value holding a third of the rows, plus ties elsewhere
    return [(i, Decimal(500) if i % 3 == 0 else Decimal(rnd.randint(1, distinct)) / 4) for i in range(n)]


def test_running_totals_matches_sorted_cumsum(spark):
    rows = _values(600)
    df = spark.createDataFrame(rows, "id long, v decimal(12,2)")
    out = running_totals(df, [Key("v", False), Key("id")], ["v"]).toPandas()
    pdf = pd.DataFrame(rows, columns=["id", "v"]).sort_values(["v", "id"], ascending=[False, True])
    pdf["pos"] = range(1, len(pdf) + 1)
    pdf["cum"] = pdf["v"].cumsum()
    got = out.set_index("id").loc[pdf["id"]]
    assert list(got["row_pos"]) == list(pdf["pos"])
    assert [Decimal(x) for x in got["v_cum"]] == list(pdf["cum"])
    assert set(got["total_rows"]) == {600}


def test_running_totals_spreads_a_hot_value_over_partitions(spark):
    rows = [(i, 1) for i in range(3000)] + [(3000 + i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = range_partitioned(df, [Key("v"), Key("id")]).where("v = 1").select("_part").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts >= 4


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "id long, v long")
    assert running_totals(df, [Key("id")], ["v"]).count() == 0


def test_value_ranks_match_pandas_min_max_rank(spark):
    rows = _values(500, seed=3, distinct=25)
    df = spark.createDataFrame(rows, "id long, v decimal(12,2)")
    got = {float(r["v"]): (r["rank_lo"], r["rank_hi"], r["rank_n"]) for r in value_ranks(df, "v").collect()}
    s = pd.Series([float(v) for _, v in rows])
    want = {v: (int(a), int(b), 500) for v, a, b in zip(s, s.rank(method="min"), s.rank(method="max"))}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 11, 23, 59, 100])
def test_quintile_score_equals_pandas_rank_pct_cut(spark, n):
    rnd = random.Random(n)
    vals = [rnd.randint(0, max(1, n // 3)) for _ in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long")
    score = quintile_from_bounds(F.col("rank_lo"), F.col("rank_hi"), F.col("rank_n"))
    got = (with_score(df, "v", score, "q").select("id", "q").toPandas().set_index("id").sort_index()["q"].tolist())
    pct = pd.Series(vals).rank(method="average", pct=True)
    want = pd.cut(pct, bins=[0, .2, .4, .6, .8, 1.0], labels=[1, 2, 3, 4, 5], include_lowest=True).astype(int)
    assert got == want.tolist()


def test_repeat_count_splits_a_hot_group_and_keeps_nulls(spark, monkeypatch):
    import tillroll.operators.repeats as repeats
    monkeypatch.setattr(repeats, "PIECE_ROWS", 2)
    rows = [("a", None)] * 7 + [("b", 1)] * 2 + [(None, 2)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "k string, x long")
    out = with_repeat_count(df, "n").toPandas()
    assert len(out) == len(rows)
    got = sorted(repr((r.k, None if pd.isna(r.x) else int(r.x), int(r.n))) for r in out.itertuples())
    want = sorted(repr((k, x, rows.count((k, x)))) for k, x in rows)
    assert got == want


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(11)
    vals = [rnd.choice([1.0, 2.5, 2.5, 3.0]) * rnd.randint(1, 50) for _ in range(777)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    qs = (0.25, 0.5, 0.75, 0.9, 0.99, 0.999)
    got = {r["quantile"]: r["value"] for r in exact_quantiles(df, "x", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(vals, q)), rel=1e-12, abs=1e-12)


def test_describe_matches_pandas(spark):
    rnd = random.Random(5)
    vals = [Decimal(rnd.randint(1, 100000)) / 100 for _ in range(333)]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(12,2)")
    row = describe(df, ["x"]).collect()[0]
    d = pd.Series([float(v) for v in vals]).describe()
    assert row["count"] == d["count"]
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert row[ours] == pytest.approx(d[theirs], rel=1e-9)


def test_equal_width_histogram_matches_numpy(spark):
    rnd = random.Random(9)
    vals = [rnd.uniform(0, 1000) for _ in range(1000)] + [1000.0, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r["count"] for r in equal_width_histogram(df, "x", 50).orderBy("bin").collect()]
    want, _ = np.histogram(vals, bins=50)
    assert got == list(want)


def test_top_values_keeps_null_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), ("c",), ("c",)], "v string")
    got = [(r["v"], r["rows"], r["rank"]) for r in top_values(df, "v", 3).orderBy("rank").collect()]
    assert got == [("c", 2, 1), (None, 2, 2), ("a", 1, 3)]


def test_grouped_top_values_with_a_hot_group(spark):
    rows = [("hot", f"v{i % 300}") for i in range(3000)] + [("hot", "v7")] * 5 + [("cold", "a"), ("cold", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    got = {(r["g"], r["rank"]): (r["v"], r["rows"])
           for r in top_values(df, "v", 3, group_cols=("g",), salts=16).collect()}
    assert got[("hot", 1)] == ("v7", 15)
    # ties at 10 rows: smallest values first
    assert got[("hot", 2)] == ("v0", 10) and got[("hot", 3)] == ("v1", 10)
    assert got[("cold", 1)] == ("a", 1) and got[("cold", 2)] == (None, 1)


def test_describe_constant_column_has_zero_std(spark):
    df = spark.createDataFrame([(Decimal("987654.32"),)] * 1000, "x decimal(12,2)")
    row = describe(df, ["x"]).collect()[0]
    assert row["std"] == 0.0 and row["mean"] == 987654.32 and row["p50"] == 987654.32


def test_describe_keeps_every_decimal_place(spark):
    prices = ["0.0010", "0.0420", "1.2345", "2.5550"]
    df = spark.createDataFrame([(Decimal(v),) for v in prices], "x decimal(18,4)")
    row = describe(df, ["x"]).collect()[0]
    d = pd.Series([float(v) for v in prices]).describe()
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                         ("max", "max")):
        assert row[ours] == pytest.approx(d[theirs], rel=1e-12)


def test_describe_of_several_columns_empty_and_null(spark):
    df = spark.createDataFrame([(1, Decimal("2.50")), (None, Decimal("3.50")), (4, None)], "a long, b decimal(12,2)")
    a, b = describe(df, ["a", "b"]).orderBy("column").collect()
    assert (a["count"], a["mean"], a["min"], a["p50"]) == (2, 2.5, 1.0, 2.5)
    assert (b["count"], b["mean"], b["max"]) == (2, 3.0, 3.5)
    e = describe(df.limit(0), ["a"]).collect()[0]
    assert e["count"] == 0 and e["mean"] is None
    with pytest.raises(ValueError):
        describe(df.select(F.col("a").cast("double").alias("x")), ["x"])


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("values", [
    ["0.0000", "400000000.0000"] * 3 + ["400000000.0000"],
    ["10000000000000.0000", "10000000000000.0001", "9999999999999.9999", "10000000000000.0002"],
    ["10000000000000.0000", "-10000000000000.0000", "0.0001", "3.0000"],
    ["12345678901234567890123.0001", "1.0000", "-12345678901234567890123.0001"],
    ["0.0001", "0.0002", "0.0004"] * 5,
])
def test_describe_of_large_and_small_values(spark, values, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(Decimal(v),) for v in values], "x decimal(38,4)")
        row = describe(df, ["x"]).collect()[0]
        whole = [int(Decimal(v).scaleb(4)) for v in values]
        n = len(whole)
        var = Fraction(n * sum(u * u for u in whole) - sum(whole) ** 2, n * (n - 1) * 10 ** 8)
        d = pd.Series([float(v) for v in values]).describe()
        assert row["std"] == pytest.approx(float(var) ** 0.5, rel=1e-14)
        assert row["mean"] == pytest.approx(float(Fraction(sum(whole), n * 10 ** 4)), rel=1e-15, abs=1e-300)
        for ours, theirs in (("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert row[ours] == pytest.approx(d[theirs], rel=1e-12)
        # pandas' own std loses digits where the mean is large against the spread
        if max(abs(u) for u in whole) < 10 ** 13 or len(values) == 4 and "3.0000" in values:
            assert row["std"] == pytest.approx(d["std"], rel=1e-12)
        with pytest.raises(Exception, match="digits"):
            describe(spark.createDataFrame([(Decimal(10) ** 24,)], "x decimal(38,4)"), ["x"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_tail_histogram_matches_numpy(spark):
    rnd = random.Random(12)
    vals = [round(rnd.lognormvariate(3, 1), 2) for _ in range(900)]
    got = tail_histogram(spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double"), "x", 50, 0.99).orderBy("bin").collect()
    cut = np.quantile(vals, 0.99)
    want, edges = np.histogram([v for v in vals if v <= cut], bins=50)
    assert [r["count"] for r in got] == list(want) and got[0]["cut_value"] == pytest.approx(cut, rel=1e-12)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]), rel=1e-12)
    one = tail_histogram(spark.createDataFrame([(5.0,)] * 3, "x double"), "x", 4, 0.99).orderBy("bin").collect()
    assert [r["count"] for r in one] == [3, 0, 0, 0]
