"""Text statistics against a plain reading of their definition; outliers by MCD."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import mcd_rules as m
from tillroll.llm.store import stored, table

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(text):
    text = text or ""
    words = [w for w in re.split(f"[{BLANK}]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(hit), failed)


def test_statistics_of_the_whole_table_and_hard_texts(spark):
    rnd = random.Random(3)
    hard = ["", None, " \n\t", "a b c d e a b c d e", "x " * 40, "a\xa0b c", "one\r\ntwo\r\none\r\n", "\n\n", "é \U0001F600 #|<",
            " lead and trail \x0b\x0c", "a b c d e f a b c d e g b c d e f", "w " * 30000]
    hard += [" ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40))) + rnd.choice(["", "\n", " "]) for _ in range(200)]
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame([(10**6 + k, t, "xx", "hand") for k, t in enumerate(hard)],
                              "doc_id long, text string, lang string, source string"))
    got = {r["doc_id"]: tuple(r)[1:7] for r in m.judge(docs).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == brute(r["text"]), (r["doc_id"], (r["text"] or "")[:80])


def test_estimates_resist_outliers(spark):
    rng = np.random.default_rng(6)
    a = rng.multivariate_normal([1, 2, 0, 0], np.diag([1, 4, 0.2, 0.2]) + 0.1, 3000)
    bad = rng.normal(30, 1, (600, 4))
    rows = [(1, *map(float, x)) for x in np.vstack([a, bad])] + [(2, 0.0, 0.0, 0.0, 0.0)] * 50
    vectors = stored(spark.createDataFrame(rows, "g long, x0 double, x1 double, x2 double, x3 double"), "test-vectors")
    got = {r["g"]: r for r in m.mcd(vectors).collect()}
    centre = np.array([got[1][f"m{i}"] for i in range(4)])
    assert np.abs(centre - [1, 2, 0, 0]).max() < 0.2
    assert [got[2][f"m{i}"] for i in range(4)] == [0, 0, 0, 0]
    d2 = np.array([r["d2"] for r in m._distances(vectors.where("g = 1"), m.mcd(vectors), 4).orderBy("x0").collect()])
    assert (d2[-600:] > 200).all() and np.median(d2[:3000]) < 10


def test_labelled_junk_goes_and_good_text_stays(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = m.judge(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")) \
        .where("quality is not null").collect()
    kept = {r["quality"]: r["kept"] for r in got}
    print(kept)
    assert kept[1] > 0.97 and kept[0] < 0.45


def test_hard_rows(spark):
    rows = [(1, "good text of more than ten words that simply goes on here", None, None)] * 2 + \
        [(None, "another text of more than ten words that goes on and on", "en", "s"), (3, None, "en", "s"), (4, "", None, "s")]
    docs = spark.createDataFrame([r + (5, True) for r in rows],
                                 "doc_id long, text string, lang string, source string, g int, kept boolean")
    got = Counter((r["doc_id"], r["base_failed"], r["kept"]) for r in m.judge(docs).collect())
    assert got == {(1, False, True): 2, (None, False, True): 1, (3, True, False): 1, (4, True, False): 1}
    assert m.judge(docs.limit(0)).count() == 0
