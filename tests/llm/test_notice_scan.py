"""Notices with edits against a plain dynamic program over every word start."""

from __future__ import annotations

import random
import re

import pytest

from tillroll.llm import notice_scan as m
from tillroll.llm.store import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda x: x.group().lower(), text or "")


def best_end(line, at, notice):
    """(edits, ends) of the closest spans that start at ``at`` and end at a word's end."""
    text, k = notice.text, notice.errors
    column, best, ends = list(range(len(text) + 1)), None, []
    for j in range(at, min(len(line), at + len(text) + k + 1)):
        if line[j] == " " and j > at and column[-1] <= k:
            if best is None or column[-1] < best:
                best, ends = column[-1], []
            if column[-1] == best:
                ends.append(j)
        last, column = column, [column[0] + 1]
        for i, c in enumerate(text):
            column.append(min(last[i + 1] + 1, column[i] + 1, last[i] + (c != line[j])))
    return best, ends


def brute(line, notices):
    out = []
    for k, n in enumerate(notices):
        found = []
        for at in (i + 1 for i, c in enumerate(line[:-1]) if c == " "):
            edits, ends = best_end(line, at, n)
            if edits is not None:
                found.append((edits, at, ends))
        out.append(found)
    return out


def edited(rnd, s, n):
    s = list(s)
    for _ in range(n):
        k = rnd.randrange(len(s))
        s[k:k + 1] = rnd.choice([[], [s[k], rnd.choice("abé ")], [rnd.choice("abé")]])
    return "".join(s)


def agree(searcher, line, notices):
    got = {}
    for k, a, b, edits in searcher.hits(line):
        got.setdefault(k, []).append((edits, a, b))
    for k, found in enumerate(brute(line, notices)):
        ends = {(e, a): set(x) for e, a, x in found}
        mine = got.get(k, [])
        assert all(b in ends[e, a] for e, a, b in mine), (line, notices[k])
        for e, a, x in found:  # what isn't reported overlaps a reported span that isn't worse
            assert any(a2 < max(x) and a < b2 and (e2, a2) <= (e, a) for e2, a2, b2 in mine), (line, notices[k], e, a)
        spans = sorted((a, b) for _, a, b in mine)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_random_edits_against_every_start():
    rnd = random.Random(5)
    notices = [n for n in m.NOTICES if n.errors] + [m.Notice("cc by", "cc-by", 1), m.Notice("aba ab", "x", 2)]
    searcher = m.Searcher(notices)
    for _ in range(600):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            n = rnd.choice(notices)
            parts.append(edited(rnd, n.text, rnd.randint(0, n.errors + 2)) if rnd.random() < 0.7 else
                         rnd.choice(["the", "mit mit", "abab aba ab", "license", "é " * 9]))
        agree(searcher, m.framed(" ".join(parts))[1], notices)


def plain(text):
    words = WORD.findall(lower(text))
    places = [(i, label) for phrase, label in m.BASE for p in [phrase.split()] for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = m.summary(m.scan(docs)).collect()
    assert len(rows) == len(texts) and any(r["n_base"] for r in rows)
    for r in rows:
        assert tuple(r)[1:6] == plain(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert (r["score"] == 1.0) if r["n_base"] else r["score"] < 1 or r["labels"]
        assert (r["score"] == 0) == (r["labels"] == "")


def test_edited_notices_get_labels_and_places(spark):
    text = "Été 2020.\nRelased undr the\tMIT-License; GNU General Pubilc Licence!"
    rows = [(1, text), (2, "an emit license"), (3, "The Apach License, v2"), (4, "licensed under CC-BY-NC 4.0"), (5, "general public office")]
    docs = spark.createDataFrame([r + ("x",) for r in rows], "doc_id long, text string, hits string")
    got = {r["doc_id"]: r for r in m.scan(docs).collect()}
    spans = {h["label"]: (text[h["start"]:h["end"]], h["edits"]) for h in got[1]["hits"]}
    assert spans["gpl"] == ("GNU General Pubilc Licence", 3)
    assert {(text[h["start"]:h["end"]], h["edits"]) for h in got[1]["hits"] if h["label"] == "mit"} == {
        ("MIT-License", 0), ("undr the\tMIT-License", 1)}
    assert got[2]["hits"] == [] and got[5]["hits"] == []
    assert [(h["label"], h["edits"]) for h in got[3]["hits"]] == [("apache", 1)]
    out = {r["doc_id"]: r for r in m.summary(m.scan(docs)).collect()}
    assert (out[3]["n_base"], out[3]["base_labels"], out[3]["labels"], out[3]["first_word"]) == (0, "", "apache", None)
    assert (out[4]["base_labels"], out[4]["labels"], out[4]["score"]) == ("cc-by", "cc-by,cc-by-nc", 1.0)
    assert out[2]["score"] == 0.0


def test_hard_rows(spark):
    long = "mit license " * 30000
    rows = [(1, None), (2, ""), (3, "  \n."), (None, "MIT license"), (4, long), (5, "cc by cc by"), (5, "cc by cc by"), (6, "ccby cc-by\x00x")]
    docs = spark.createDataFrame([r + (7,) for r in rows], "doc_id long, text string, n_words int")
    got = sorted((tuple(r) for r in m.summary(m.scan(docs)).collect()), key=str)
    assert sorted((r[0:6] for r in got), key=str) == sorted(((d, *plain(t)) for d, t in rows), key=str)
    assert m.scan(docs.limit(0)).count() == 0
    assert m.scan(docs, []).where("size(hits) > 0").count() == 0
    for bad in (m.Notice("Upper", "x", 0), m.Notice("two  blanks", "x", 0), m.Notice("ab", "x", 2), m.Notice("", "x", 0)):
        with pytest.raises(ValueError):
            m.Searcher([bad])
