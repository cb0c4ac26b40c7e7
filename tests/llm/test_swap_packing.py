"""Packing: every piece placed once, sequences gapless, bins near or at the bound."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tillroll.llm import swap_packing as sp
from tillroll.llm.store import table

PATH = public_tokenizers.path("word_bpe_49k.json")


def _used(classes, histogram, capacity):
    got = Counter()
    for items, n in classes:
        assert 0 < sum(items) <= capacity and n > 0
        for x in items:
            got[x] += n
    assert +got == +Counter(histogram)
    return sum(n for _, n in classes)


def _fewest(items, capacity):
    """Exact bin packing by search over set partitions (tiny inputs)."""
    best = [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity:
                go(k + 1, bins[:i] + [bins[i] + items[k]] + bins[i + 1:])
        go(k + 1, bins + [items[k]])

    go(0, [])
    return best[0]


def test_plan_near_the_optimum_on_tiny_inputs():
    rnd = random.Random(2)
    over = 0
    for _ in range(60):
        items = sorted((rnd.randint(3, 20) for _ in range(9)), reverse=True)
        over += _used(sp.plan(Counter(items), 20), Counter(items), 20) - _fewest(items, 20)
    assert 0 <= over <= 2


def test_local_search_empties_bins_that_best_fit_leaves():
    # best fit decreasing takes 3 bins of 10: (6,4) (5,3) (2,...) is improved by exchanges
    histogram = Counter([6, 5, 5, 4, 4, 3, 3])
    bins = sp.Bins(10)
    for x in sorted(histogram, reverse=True):
        bins.best_fit(x, histogram[x])
    assert _used(sp.plan(histogram, 10), histogram, 10) == 3 <= sum(bins.count.values())
    rnd = random.Random(9)
    gained = 0
    for _ in range(40):
        h = Counter(rnd.randint(20, 60) for _ in range(120))
        b = sp.Bins(100)
        for x in sorted(h, reverse=True):
            b.best_fit(x, h[x])
        gained += sum(b.count.values()) - _used(sp.plan(h, 100), h, 100)
    assert gained > 0


def test_counts_of_any_size_take_the_same_plan():
    h = {700: 10**9, 300: 10**9 + 7, 1100: 3 * 10**8, 2048: 5, 1: 12}
    bins = _used(sp.plan(h, 2048), h, 2048)
    assert bins <= 1.02 * sum(k * n for k, n in h.items()) / 2048 + 1e9 / 3  # 1100s and 700s don't tile fully


def test_documents(spark, sf):
    docs = table(spark, sf, "documents")
    t = Tokenizer.from_file(PATH)
    want = {}
    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[r["doc_id"], p] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    placed = sp.pack_documents(docs, PATH).cache()
    rows = placed.collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert len(rows) == len(want)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(x[1] for x in want.values())
    assert len(by) <= -(-total // 2048) + 1
    sequences = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sp.sequence_ids(docs, placed, PATH).collect()}
    assert sum(map(len, sequences.values())) == total
    for r in rows[:50]:
        part = sequences[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_hot_length_nulls_repeats_empty(spark):
    docs = spark.createDataFrame([(k, "same words here", "x") for k in range(500)] + [(7, "same words here", "y")] * 3
                                 + [(None, None, None), (900, "", "z")], "doc_id long, text string, length string")
    rows = sp.pack_documents(docs, PATH, capacity=10).collect()
    assert len(rows) == 505
    assert Counter(r["length"] for r in rows) == {4: 503, 1: 2}
    assert len({r["sequence_id"] for r in rows}) == 252
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 505
    assert sp.pack_documents(docs.limit(0), PATH).count() == 0
