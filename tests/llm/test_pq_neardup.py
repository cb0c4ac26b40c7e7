"""Links and components against brute-force cosines; recall of the index."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
from tillroll.llm import pq_neardup as m
from tillroll.llm.store import table


def brute(rows, limit=0.95):
    dims = max((len(v) for _, v in rows if v), key=[len(v) for _, v in rows if v].count, default=0)
    ok = [i for i, (d, v) in enumerate(rows) if d is not None and v and len(v) == dims and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    x = np.array([rows[i][1] for i in ok], float).reshape(len(ok), -1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    parent = list(range(len(ok)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = np.zeros(len(ok), int)
    for a in range(len(ok)):
        for b in np.flatnonzero(x[a] @ x.T >= limit):
            if a != b:
                links[a] += 1
                parent[find(a)] = find(b)
    low = {}
    for k, i in enumerate(ok):
        low[find(k)] = min(rows[i][0], low.get(find(k), rows[i][0]))
    out = [(d, 0, d, True) for d, _ in rows]
    for k, i in enumerate(ok):
        out[i] = (rows[i][0], int(links[k]), low[find(k)], rows[i][0] == low[find(k)])
    return out


def test_recall_on_the_whole_table_with_noisy_copies(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], list(r["embedding"])) for r in vectors.collect()]
    rng = np.random.default_rng(8)
    for k in range(1500):  # cosines from 0.93 to 0.999
        v = np.array(rows[rng.integers(0, 400)][1])
        v = v / np.linalg.norm(v) + rng.normal(size=64) / 8 * rng.uniform(0.04, 0.4)
        rows.append((10**6 + k, [float(np.float32(e)) for e in v]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in m.near_duplicates(df).collect())
    want = sorted(brute(rows))
    recall = sum(g[1] for g in got) / sum(w[1] for w in want)
    print("links", sum(w[1] for w in want), "recall", recall)
    assert recall >= 0.995 and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.995 * len(want)


def test_exhaustive_probes_lose_nothing(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(40, 16))
    x = np.concatenate([c + rng.normal(size=(30, 16)) * rng.uniform(0.05, 0.4) for c in centre])
    rows = [(k, [float(e) for e in v]) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in m.near_duplicates(df, m.Settings(sigmas=4.0, block=64)).collect())
    assert got == sorted(brute(rows))  # 16 dimensions: four sigmas are the whole radius


def test_hard_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    rows = [(k, [float(e) for e in base]) for k in range(300)]
    rows += [(300 + k, [float(e) for e in base + rng.normal(size=8) * 0.02]) for k in range(300)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] + [1.0] * 7), (1004, [None] + [1.0] * 7),
             (1005, [float("inf")] * 8), (1006, [1.0, 2.0]), (1007, [1.0, 2.0]), (1008, [-float(e) for e in base]),
             (1009, [float(e) * 1e30 for e in base]), (-5, [float(e) * 1e-30 for e in base])]
    df = spark.createDataFrame([r + (1, 2) for r in rows], "vec_id long, embedding array<float>, c int, label int")
    want = brute([(d, None if v is None else [None if e is None else float(np.float32(e)) for e in v]) for d, v in rows])
    assert sorted(tuple(r) for r in m.near_duplicates(df, m.Settings(block=32)).collect()) == sorted(want)
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}))
    assert sorted(con.sql(m.near_duplicates_sql()).fetchall()) == sorted(want)
    assert m.near_duplicates(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, None)],
                                "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in m.near_duplicates(odd).collect()), key=str) == \
        [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, True), (None, 0, None, True)]
