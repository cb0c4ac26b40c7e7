"""Edit distance, segment lookups and dropped lines against plain definitions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import line_dedup as m
from tillroll.llm.store import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rnd, line, n):
    s = list(line)
    for _ in range(n):
        k = rnd.randrange(len(s) + 1)
        how = rnd.randrange(3)
        if how == 0:
            s.insert(k, rnd.choice("abé"))
        elif s:
            k = min(k, len(s) - 1)
            s[k:k + 1] = [] if how == 1 else [rnd.choice("abé")]
    return "".join(s)


def test_banded_distance():
    rnd = random.Random(3)
    for _ in range(4000):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 24)))
        b = edited(rnd, a, rnd.randint(0, 5)) if rnd.random() < 0.8 else "".join(rnd.choice("ab") for _ in range(20))
        for t in (0, 1, 2, 3):
            assert m.within(a, b, t) == (distance(a, b) <= t), (a, b, t)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_every_close_pair_shares_a_probe(t):
    rnd = random.Random(t)
    plan = m._Plan(t, t + 1)
    for _ in range(4000):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randint(t + 1, 30)))
        b = edited(rnd, a, rnd.randint(0, t))
        a, b = sorted((a, b), key=len)
        if len(a) > t:
            own = {(s, a[x // 4:y // 4]) for s, x, y in plan[len(a)][0]}
            assert own & {(s, b[x // 4:y // 4]) for s, x, y in plan[len(b)][1]}, (a, b)
    assert [len(plan[60][1])] == [{1: 4, 2: 12, 3: 25}[t]] or t == 3


def brute(rows, t, least):
    seen, out = [], {}
    for d, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for j, line in enumerate(text.split("\n") if text is not None else []):
            line = line.strip(m.BLANKS)
            if len(line) >= least:
                if any(abs(len(line) - len(x)) <= t and m.within(line, x, t) for x in seen):
                    out.setdefault(d, []).append(j)
                seen.append(line)
    return out


@pytest.mark.parametrize("t", [1, 2])
def test_random_lines(spark, t):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdefgé ") for _ in range(rnd.randint(8, 60))) for _ in range(60)]
    rows = []
    for d in range(150):
        lines = [edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2, 3])) if rnd.random() < 0.6 else
                 "".join(rnd.choice("abcdefgé ") for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(0, 8))]
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["dropped"] for r in m.duplicate_lines(docs, t, 6).collect()}
    assert got == brute(rows, t, 6)


def test_hard_rows(spark):
    line = "a line that is long enough to count"
    rows = [(k, line) for k in range(400)] + [(400, None), (401, ""), (402, f"{line}\n\n  {line}\t\nshort\nshort"),
                                              (None, line), (403, line[:-1] + "X"), (404, "z" * 50000), (405, "z" * 50001)]
    docs = spark.createDataFrame([r + (1, 2) for r in rows], "doc_id long, text string, row int, h1 int")
    dropped = m.duplicate_lines(docs, 2, 20)
    got = {r["doc_id"]: r["dropped"] for r in dropped.collect()}
    assert got == {**{k: [0] for k in range(1, 400)}, 402: [0, 2], 403: [0], 405: [0]}
    left = {r["doc_id"]: r["text"] for r in m.without_lines(docs, dropped).collect()}
    assert left[0] == line and left[7] == "" and left[402] == "\nshort\nshort" and left[None] == line and left[400] is None
    assert m.without_lines(docs, dropped).columns == docs.columns
    assert m.duplicate_lines(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(5, line), (5, line), (5, f"x\n{line}"), (6, line)], "doc_id long, text string")
    kept = m.without_lines(twice, m.duplicate_lines(twice))
    assert sorted(r["text"] for r in kept.collect()) == ["", line, line, "x"]
    with pytest.raises(ValueError):
        m.duplicate_lines(docs, 20, 20)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"]: r["dropped"] for r in m.duplicate_lines(docs).collect()} == brute(rows, 2, 20)
    assert docs.where(F.col("text").isNull()).count() == 0


def test_short_equal_lines(spark):
    rows = [(1, "}\nread more\n \nread  more"), (2, "  read more\n}\nx"), (2, "x"), (3, "Read more\nx\t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["row"]): r["dropped"] for r in m.duplicate_lines(docs, 2, 20, least_equal=1).collect()}
    assert sorted((d, x) for (d, _), x in got.items()) == [(2, [0, 1, 2]), (3, [1])]  # "x" stands first in (2, line 0)
    assert m.duplicate_lines(docs, 2, 20).count() == 0


@pytest.mark.parametrize("many", [100, 20_000])
def test_thousands_of_variants_of_one_line(spark, monkeypatch, many):
    """Every line shares segments with every other; rows stay in proportion to the lines."""
    monkeypatch.setattr(m, "MANY", many)
    rnd = random.Random(11)
    base = "all the lines of this large group are variants of one and the same line"
    other = "the lines of that group have one third in common, and "
    rows = [(0, base)] + [(k, edited(rnd, base, 2)) for k in range(1, 5000)]
    rows += [(k, other + "".join(rnd.choice("abcdefgh") for _ in range(len(other) * 2))) for k in range(5000, 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["dropped"] for r in m.duplicate_lines(docs).collect()}
    assert got == {k: [0] for k in range(1, 5000)}
    lines = len({t for _, t in rows})
    assert m._candidates(m._prepared(docs), 2, 20).count() <= (5 if many == 100 else 1) * 15 * lines


def test_larger_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    by_length, whole, out = {}, set(), {}
    for d, text in rows:
        for j, line in enumerate(text.split("\n")):
            line = line.strip(m.BLANKS)
            if not line:
                continue
            near = line in whole
            if not near and len(line) >= 20:
                # of two edits, one leaves the first or the last seven characters where they are, or both lie outside the middle
                keys = {("a", line[:6]), ("z", line[-6:])} | {("m", line[p:p + 6]) for p in range(len(line) // 2 - 5, len(line) // 2 + 3)}
                own = {("a", line[:6]), ("z", line[-6:]), ("m", line[len(line) // 2 - 2:len(line) // 2 + 4])}
                near = any(m.within(line, x, 2) for n in range(len(line) - 2, len(line) + 3) for k in keys for x in by_length.get((n, k), ()))
                for k in own:
                    by_length.setdefault((len(line), k), []).append(line)
            whole.add(line)
            if near:
                out.setdefault(d, []).append(j)
    got = {r["doc_id"]: r["dropped"] for r in m.duplicate_lines(docs, least_equal=1).collect()}
    assert got == out
