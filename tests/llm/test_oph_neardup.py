"""Near-duplicate components against brute force over full shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np

from tillroll.llm import oph_neardup as m
from tillroll.llm.store import table
from tillroll.oracle.compare import duck_connection

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    """{(doc_id, n_shingles)} → component by all pairs (through an inverted index)."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index, common = {}, {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            for j in index.setdefault(x, []):
                common[i, j] = common.get((i, j), 0) + 1
            index[x].append(i)
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i][1]) + len(sets[j][1]) - c):
            parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(s), low[find(i)], d == low[find(i)]) for i, (d, s) in enumerate(sets)]


def test_signature_agrees_with_similarity():
    rnd = np.random.default_rng(4)
    for n in (3, 8, 60, 3000):
        same = []
        for _ in range(30):
            base = rnd.integers(0, 2**64, 5 * n, dtype=np.uint64)
            a, b = np.unique(base[: 4 * n + n // 2]), np.unique(base[n // 2:])
            same.append((m.signature(a) == m.signature(b)).mean())
        assert abs(np.mean(same) - 0.8) < 0.03, (n, np.mean(same))  # 4n shared of 5n


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    for k in (2, 5):
        got = sorted(tuple(r) for r in m.near_duplicates(docs, k).collect())
        assert got == sorted(brute(rows, k))
        assert sorted(duck_connection("/root/testdata/sf0.01").sql(m.near_duplicates_sql(k)).fetchall()) == got


def test_hard_rows(spark):
    rnd = random.Random(1)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(60)]
    near = [" ".join(base[:i] + ["x"] + base[i + 1:]) for i in range(0, 60, 2)]
    rows = [(k, t) for k, t in enumerate(near)] + [(100 + k, " ".join(base)) for k in range(200)]
    rows += [(500, ""), (501, None), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "É é"),
             (507, "é é"), (508, "a b\xa0c"), (509, "a b c"), (510, "same words " * 9000), (511, "Same words " * 9001),
             (505, "one two"), (-3, "neg ative"), (512, "neg ative")]
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, set_hash string, rep int")
    assert sorted(tuple(r) for r in m.near_duplicates(docs, 2).collect()) == sorted(brute(rows, 2))
    assert m.near_duplicates(docs.limit(0), 2).count() == 0
    odd = spark.createDataFrame([(None, "one two"), (1, "one two"), (None, "one two"), (2, "one two")],
                                "doc_id long, text string")
    assert sorted(map(str, map(tuple, m.near_duplicates(odd, 2).collect()))) == sorted(
        ["(None, 1, None, True)", "(None, 1, None, True)", "(1, 1, 1, True)", "(2, 1, 1, False)"])


def test_links_that_no_star_shows(spark):
    """Dense groups of variants: only two of each are near enough to each other, and all
    their buckets are shared with most of the group."""
    rnd = random.Random(7)
    rows, want = [], {}
    for g in range(3):
        base = [f"g{g}w{k}" for k in range(200)]
        changes = [range(11), range(11, 22)] + [rnd.sample(range(22, 200), 20) for _ in range(400)]
        ids = rnd.sample(range(1000 * g, 1000 * g + 1000), len(changes))
        for d, at in zip(ids, changes):
            rows.append((d, " ".join(f"d{d}c{k}" if k in set(at) else w for k, w in enumerate(base))))
            want[d] = d
        want[max(ids[:2])] = min(ids[:2])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in m.near_duplicates(docs, 1).collect()} == want


def test_small_blocks_meet_all_pairs(spark):
    """Every pair of a bucket that lies in two components, once, at any size of block."""
    rnd = random.Random(8)
    sets = [np.unique(np.array([rnd.getrandbits(64) for _ in range(3)], np.uint64)) for _ in range(40)]
    held = spark.createDataFrame([(d, [int(v) for v in x.view(np.int64)]) for d, x in enumerate(sets)], "doc_id long, shingles array<long>")
    roots = {d: 0 if d < 15 else 15 if d < 22 else d for d in range(40)}
    found = spark.createDataFrame([(d, r) for d, r in roots.items() if d != r], "id long, root long")
    members = spark.createDataFrame([(d, 3, key) for d in range(40) for key in (1, 2) if key == 1 or d % 2], "b long, nb long, key long")
    for size in (3, 512):
        got = [tuple(r) for r in m._left_pairs(members, found, held, 0, size).collect()]
        assert sorted(got) == [(a, b) for a in range(40) for b in range(a + 1, 40) if roots[a] != roots[b]]
