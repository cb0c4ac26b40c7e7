"""Nodes of the prefix trie against plain dictionaries, and the SQL statement."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import prefix_trie as m
from tillroll.llm.store import table
from tillroll.oracle.compare import duck_connection


def brute(paths):
    """Nodes of conv_id → [(role, text), ...]."""
    members, ends = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) or 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in below)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(c), len(node), min(members[node[:-1]]) if node else None, len(c), len(kids.get(node, [])), leaves[node], saved[node],
                   sha(ends.get(node, []))) for node, c in members.items())


def ordered(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out.setdefault(c, []).append((turn is not None, turn or 0, *(int.from_bytes(x, "little", signed=True) for x in
                                          (m.digest(role, text)[:8], m.digest(role, text)[8:])), role, text))
    return {c: [x[-2:] for x in sorted(v)] for c, v in out.items()}


def rebuilt(rows):
    own = ordered(rows)
    def path(c):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        return own.get(base, [])[:h] + own[c][h:]
    return {c: path(c) for c in own}


def nodes(df):
    return sorted(tuple(r) for r in df.collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def random_rows(seed, n):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(n), rnd.choice([None, 0, 1, 2, 3, 4, 5, 6, 7]), rnd.choice([None, "", "user", "bot"]),
             rnd.choice([None, "", "a", "bé", "𝒳yz"])) for _ in range(n * 5)]
    return rows + [(None, 1, "user", "x"), (-7, 1, "u", "neg"), (-7, 2, "u", "é")]


@pytest.mark.parametrize("cells", [16, 512, 1 << 20])
def test_trie_at_any_sketch(spark, cells):
    rows = random_rows(cells, 400)
    t = m.turns(spark.createDataFrame([r + (1, 2) for r in rows], SCHEMA + ", a int, depth int"))
    assert nodes(m.trie(t, most_cells=cells)) == brute(ordered(rows))


def test_branched_trie(spark):
    rows = random_rows(3, 700)
    assert nodes(m.branched_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rebuilt(rows))


def test_long_and_equal_conversations(spark):
    long = [(c, t, "user", f"turn {t} é") for c in (5, 6, 9) for t in range(1300 if c != 9 else 512)]
    long += [(7, t, "user", f"other {t}") for t in range(1025)]
    same = [(c, t, "user", "hello") for c in range(1000, 14000) for t in range(2)]
    rows = long + same
    got = nodes(m.trie(m.turns(spark.createDataFrame(rows, SCHEMA))))
    assert got == brute(ordered(rows))


def test_no_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert m.branched_trie(empty).count() == 0
    # 102 takes its first turns from 100, which isn't there, and loses its own
    h = m.branch_length(102)
    rows = [(102, t, "u", "x") for t in range(h)] if h else []
    lone = [(c, 0, "u", "x") for c in range(101, 200) if m.branch_length(c) > 0]
    got = nodes(m.branched_trie(spark.createDataFrame(lone, SCHEMA)))
    assert got == brute(rebuilt(lone)) and len(got) == 1
    if rows:
        assert nodes(m.branched_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rebuilt(rows))


def test_lengths_agree_with_spark(spark):
    ids = [0, 1, -1, 99, 100, 2**62, -(2**63)]
    got = spark.createDataFrame([(i,) for i in ids], "c long").select((F.crc32(F.col("c").cast("string").cast("binary")) % 6)).collect()
    assert [r[0] for r in got] == [m.branch_length(i) for i in ids]


def test_whole_table_and_sql(spark, sf):
    got = nodes(m.branched_trie(table(spark, sf, "conversations")))
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rebuilt(rows))
    out = duck_connection(sf).sql(m.branched_trie_sql()).fetchall()
    assert sorted(tuple(r) for r in out) == got
