"""Curve, quantisation and shard laws."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pytest

from tillroll.llm import hilbert_shards as h
from tillroll.llm.store import table


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 3), (3, 4), (2, 1)])
def test_curve_visits_every_cell_by_unit_steps(spark, dims, bits):
    rows = {r["place"]: r["cell"] for r in h.curve(spark, dims, bits).collect()}
    assert sorted(rows) == list(range(1 << (dims * bits))) and len(set(rows.values())) == len(rows)
    low = (1 << bits) - 1
    at = [[rows[p] >> (bits * (dims - 1 - d)) & low for d in range(dims)] for p in sorted(rows)]
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in itertools.pairwise(at))


def _check(rows, texts, n):
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in texts)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(by) <= set(range(n))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(k, [])) for k in range(n)]
    assert max(counts) - min(counts) <= 1
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    # shards are runs of the curve
    places = [[r["place"] for r in rows if r["shard"] == k] for k in range(n) if by.get(k)]
    assert all(max(a) <= min(b) for a, b in itertools.pairwise(places))


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = h.shards(docs, ["lang", "source", "n_chars"]).collect()
    _check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 16)


def test_curve_prunes_on_every_column(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    placed = h.shards(docs, ["lang", "n_chars"], bits=4).join(docs, "doc_id").collect()
    shards_of = lambda keep: len({r["shard"] for r in placed if keep(r)})
    assert shards_of(lambda r: r["lang"] == "es") <= 8
    assert shards_of(lambda r: r["n_chars"] > 4000) <= 10


def test_hard_rows(spark, tmp_path):
    rows = [(k, "same", "en", "hot", 4) for k in range(300)] + [(k, "é" * k, None, f"s{k}", None) for k in range(300, 340)]
    rows += [(7, "same", "en", "hot", 4), (None, "no id", "en", "hot", 4), (None, "no id", "en", "hot", 4), (400, None, "de", "x", 1), (401, "", "fr", None, -5)]
    docs = spark.createDataFrame([r + (1, 2) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, cell int, rank int")
    got = h.shards(docs, ["lang", "source", "n_chars"], 16)
    _check(got.collect(), [(r[0], r[1]) for r in rows], 16)
    _check(h.shards(docs.limit(3), ["lang", "source", "n_chars"], 16).collect(),
           [(r["doc_id"], r["text"]) for r in docs.limit(3).collect()], 16)
    assert h.shards(docs.limit(0), ["lang", "source", "n_chars"]).count() == 0
    one = docs.where("doc_id >= 300").drop("cell", "rank")
    placed = h.shards(one, ["source"], 4)
    h.write_shards(one, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == one.count() and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
    with pytest.raises(ValueError):
        h.shards(docs, ["lang", "source", "n_chars"], bits=6)
