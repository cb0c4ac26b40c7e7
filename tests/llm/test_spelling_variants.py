"""Index, searches, groups and counts against plain definitions, and the SQL statement."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import spelling_variants as m
from tillroll.llm.store import table
from tillroll.oracle.compare import duck_connection


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    form, out = {}, {}
    cuts = {}
    for w in words:
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            cuts.setdefault(x, []).append(w)
    others = {w: set() for w in words}
    for group in cuts.values():
        for a in group:
            others[a].update(b for b in group if b not in others[a] and near(a, b))
    for w, n in words.items():
        best = min(((-words[x], x) for x in others[w]), default=(0, None))
        form[w] = best[1] if best[1] and -best[0] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(others[w]), words[form[w]] if form[w] else None)
    return out


def groups(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def random_words(seed, n, letters="abé", low=2, high=9):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))): int(10 ** rnd.uniform(0.3, 4)) for _ in range(n)}


def test_suffix_array():
    rnd = np.random.default_rng(1)
    for n, letters in ((1, 1), (2, 1), (9, 1), (50, 2), (400, 3)):
        text = rnd.integers(0, letters, n)
        plain = sorted(range(n), key=lambda i: text[i:].tolist())
        assert m.suffix_array(text).tolist() == plain


@pytest.mark.parametrize("letters", ["ab", "abc𝒳é", "abcdefghijklm"])
def test_searches_of_one_index(letters):
    words = sorted(random_words(2, 300, letters))
    index = m.Index(words)
    for kind in (-1, 0, 1):
        asked = [w for w in words if len(w) + kind >= 2]
        length = np.array([len(w) + kind for w in asked])
        exact = length - length // 2
        got = sorted(zip(*(x.tolist() for x in index.find(asked, length, exact))))
        want = sorted((q, k) for q, a in enumerate(asked) for k, w in enumerate(words)
                      if len(w) == length[q] and near(a, w) and (w[-exact[q]:] == a[-exact[q]:]))
        assert got == want


@pytest.mark.parametrize("block", [16, 1 << 15])
def test_groups(spark, block):
    words = random_words(3, 1500) | {"z" * 5000: 3, "z" * 5001: 30, "z" * 4000 + "y" + "z" * 1000: 300, "\x00\x01": 9, "\x00\x02": 900}
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, l string")
    assert groups(m.group_variants(df, block=block)) == brute(words)


def test_one_hot_half(spark):
    words = {f"common{a}{b}{c}{d}": 2 + 7 * i for i, (a, b, c, d) in enumerate(
        (a, b, c, d) for a in "abcdefgh" for b in "abcdef" for c in "xyzé" for d in "pqrst")}
    words |= {w + "s": 5000 for w in list(words)[::9]}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert groups(m.group_variants(df, block=32)) == brute(words)


def plain_words(rows):
    count = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x.group().lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def test_counts_of_hard_rows(spark):
    rows = [(k, "Wörterbuch WÖRTERBUCH Ärgernis ärgernis straßenbahn\nstrassenbahn5strasenbahn") for k in range(200)]
    rows += [(None, "somewhere somewhere"), (None, "somewhere"), (3, None), (4, ""), (5, "ab " * 40000 + "somewhere" * 9000), (5, "abcdefg")]
    docs = spark.createDataFrame([r + (1,) for r in rows], "doc_id long, text string, word int")
    got = {r["word"]: r["n"] for r in m.vocabulary(docs, change=m.misspell).collect()}
    assert got == plain_words(rows) and len(got) > 10
    assert groups(m.misspelled_groups(docs)) == brute(got)
    assert m.misspelled_groups(docs.limit(0)).count() == 0
    assert {r["word"]: r["n"] for r in m.vocabulary(docs, 9, 3).collect()}["wörterbuch"] == 200
    with pytest.raises(ValueError):
        m.group_variants(docs, ratio=1)


def test_whole_table_and_sql(spark, sf):
    docs = table(spark, sf, "documents")
    got = groups(m.misspelled_groups(docs))
    words = plain_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got == brute(words) and any(x[0] for x in got.values())
    rows = duck_connection(sf).sql(m.misspelled_groups_sql()).fetchall()
    assert {r[0]: tuple(r[1:]) for r in rows} == got
