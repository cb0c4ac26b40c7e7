"""Held-out accuracy of the classifier and its behaviour on hard rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import cotrain as m
from tillroll.llm.store import table


def test_logistic_and_calibration():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(6000), rng.normal(size=(6000, 3))])
    p = 1 / (1 + np.exp(-(x @ [0.5, 2.0, -1.0, 0.0])))
    y = (rng.random(6000) < p).astype(float)
    view = m.View.fit(x[:4000], y[:4000], x[4000:], y[4000:])
    assert np.abs(view.weights - [0.5, 2, -1, 0]).max() < 0.25
    assert np.abs(1 / (1 + np.exp(-view.logit(x))) - p).mean() < 0.03


def test_features_read_whole_texts():
    assert (m.content_features(None, {}) == 0).all() and (m.content_features(" \n", {}) == 0).all()
    long = "word " * 50000 + "idiot"
    assert m.content_features(long, {"idiot": 0})[-1] == 1.0
    assert np.isfinite(m.content_features("#" * 100000, {})).all()
    assert m.metadata_features(None, None, None).sum() == 3.0


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    shown = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(3)) > 0)
    got = m.classify(docs, shown).join(labels.join(shown, "doc_id", "left_anti"), "doc_id") \
        .groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()
    kept = {(r["quality"], r["toxic"]): r["kept"] for r in got}
    print({k: round(v, 4) for k, v in kept.items()})
    assert kept[1, 0] > 0.99 and kept[0, 0] < 0.03 and kept[1, 1] < 0.5


def test_views_teach_each_other(spark):
    # the text tells the class; metadata does too, but few labels show it
    good = [(k, f"plain calm words number {k}", "en", "a", 100) for k in range(600)]
    bad = [(1000 + k, f"### spam $$$ {k} ###", "en", "b", 5000) for k in range(600)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(1000 + k, 0, 0) for k in range(40)],
                                   "doc_id long, quality int, toxic int")
    d, y = m.standard(docs), m.good_labels(labels)
    alone, taught = (m.fit(d, y, m.Settings(rounds=r)) for r in (0, 3))
    # what the text view is sure of sharpens the metadata view
    far = lambda model: abs(model.metadata.weights).sum()
    assert far(taught) > far(alone)
    got = m.score(d, taught)
    assert got.where("doc_id < 1000 and not kept").count() == 0 and got.where("doc_id >= 1000 and kept").count() == 0


def test_hard_rows(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(10**9, None, "en", "s", 1), (10**9 + 1, "", None, None, None), (None, "some words here", "en", "s", 3),
                                 (5, "x " * 40000, None, "s", -7)], docs.schema)
    all_docs = docs.union(odd).union(docs.limit(3)).withColumn("score", F.lit(1)).withColumn("good", F.lit(2))
    got = m.classify(all_docs, labels)
    assert got.count() == docs.count() + 7
    assert got.where(f"doc_id >= {10**9} and (kept or score > 0)").count() == 0
    assert m.classify(docs.limit(0), labels).count() == 0
    some = docs.limit(50)
    assert m.classify(some, labels.limit(0)).where("not kept").count() == 0
    one = labels.withColumns({"quality": F.lit(1), "toxic": F.lit(None).cast("int")})
    assert m.classify(some, one).where("not kept").count() == 0


def test_every_unlabelled_document_counts(spark):
    """Sums of tasks equal those of one matrix, over all documents that the teacher is sure of."""
    rng = np.random.default_rng(4)
    lexicon = {"calm": 0, "spam": 1, "plain": 2}
    rows = [(k, " ".join(rng.choice(["calm", "spam", "plain", "x", "##"], 12)), str(rng.choice(["en", "de"])), str(rng.choice(["a", "b", "c"])),
             int(rng.integers(0, 9000))) for k in range(9000)] + [(7, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    c = np.array([m.content_features(r[1], lexicon) for r in rows], np.float64)
    meta = np.array([m.metadata_features(*r[2:]) for r in rows], np.float64)
    teacher = m.View(rng.normal(size=c.shape[1]) * 3, np.array([0.1, 1.0]))
    w = rng.normal(size=meta.shape[1]) / 5
    m.ship(spark)
    got = m._pseudo_sums(m._compact(m.standard(docs), lexicon), 3, ("c", teacher), "m", w, 0.97)
    p = m._sigmoid(teacher.logit(c))
    for y, sure in ((1, p >= 0.97), (0, p <= 0.03)):
        x, q = meta[sure], m._sigmoid(meta[sure] @ w)
        assert got[y][0] == sure.sum() > 50
        assert np.allclose(got[y][1], (x * (q * (1 - q))[:, None]).T @ x, rtol=1e-5) and np.allclose(got[y][2], x.T @ (y - q), rtol=1e-5, atol=1e-6)
    assert m._pseudo_sums(m._compact(m.standard(docs.limit(0)), lexicon), 3, ("c", teacher), "m", w, 0.97) == {}


def test_a_view_that_tells_nothing_gives_the_rate_alone():
    held, y = np.array([[1.0, x] for x in (3, 2, 4, 3, -2)]), np.array([0.0, 1, 0, 1, 1])
    view = m.View.calibrated(np.array([0.5, 2.0]), held, y)
    assert np.allclose(view.logit(held), np.log(0.6 / 0.4))
