"""Chains, alignments and passages against slow plain versions."""

from __future__ import annotations

import random

import numpy as np

from tillroll.llm import chain_dedup as m
from tillroll.llm.shingles import word_hashes, words
from tillroll.llm.store import table

S = m.Settings()


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_counts():
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(0, 30))] for _ in range(2))
        assert m.aligned(a, b) == lcs(a, b)


def test_best_chain_score():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 25)
        p, q = (np.array([rnd.randint(0, 40) for _ in range(n)]) for _ in range(2))
        order = sorted(range(n), key=lambda i: (p[i], q[i]))
        best = {}
        for i in order:
            before = [best[j] - S.gap_cost * (p[i] - p[j] + q[i] - q[j]) for j in best if p[j] < p[i] and q[j] < q[i]]
            best[i] = S.k + max([0.0, *before])
        first = m.chains(p, q, S)[0]
        total = S.k + sum(S.k - S.gap_cost * (p[b] - p[a] + q[b] - q[a]) for a, b in zip(first, first[1:]))
        assert abs(total - max(best.values())) < 1e-9
        assert all(p[a] < p[b] and q[a] < q[b] for c in m.chains(p, q, S) for a, b in zip(c, c[1:]))
        assert sorted(i for c in m.chains(p, q, S) for i in c) == list(range(n))


def test_every_long_shared_run_shares_seeds():
    rnd = random.Random(3)
    for _ in range(200):
        run = [f"w{rnd.randint(0, 999)}" for _ in range(50)]
        a, b = ([f"x{rnd.randint(0, 9999)}" for _ in range(rnd.randint(0, 40))] + run +
                [f"y{rnd.randint(0, 9999)}" for _ in range(rnd.randint(0, 40))] for _ in range(2))
        seeds = [set(m.seeds_of(word_hashes(" ".join(t)), S)[1].tolist()) for t in (a, b)]
        assert len(seeds[0] & seeds[1]) >= 2


def shared_runs(rows, least):
    """(doc_id, word place) of all words in exact runs of ``least`` words that a smaller id holds."""
    seen, out = {}, set()
    for d, t in sorted(r for r in rows if r[0] is not None):
        w = words(t)
        own = [tuple(w[i:i + least]) for i in range(len(w) - least + 1)]
        for i, g in enumerate(own):
            if seen.get(g, d) < d:
                out.update((d, j) for j in range(i, i + least))
        for g in own:
            seen.setdefault(g, d)
    return out


def test_whole_table_covers_every_exact_repeat(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    text = {d: words(t) for d, t in rows}
    got = m.repeated_passages(docs).collect()
    covered = set()
    for r in got:
        here, there = text[r["doc_id"]][r["start"]:r["end"]], text[r["source_doc_id"]][r["source_start"]:r["source_end"]]
        assert r["source_doc_id"] < r["doc_id"] and min(len(here), len(there)) >= S.least_alike * S.least_words
        assert r["n_aligned"] == m.aligned(here, there) >= S.least_alike * max(len(here), len(there))
        covered.update((r["doc_id"], j) for j in range(r["start"], r["end"]))
    want = shared_runs(rows, 50)
    print("words in exact repeats", len(want), "covered", len(want & covered), "found in all", len(covered))
    assert len(want & covered) >= 0.995 * len(want)
    # documents that share no run of 12 words with another are left alone
    clean = {d for d, _ in rows} - {d for d, _ in shared_runs(rows, 12)}
    assert not clean & {r["doc_id"] for r in got}


def test_fuzzy_passage_and_removal(spark):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randint(0, 10**6)}"
    passage = [word() for _ in range(80)]
    changed = [word() if i % 17 == 16 else w for i, w in enumerate(passage)]
    del changed[40:42]
    rows = [(1, " ".join([word() for _ in range(30)] + passage + [word() for _ in range(20)])),
            (2, "Start here\n" + " ".join(passage).upper() + "\n end  "),
            (3, " ".join([word() for _ in range(25)] + changed + [word() for _ in range(25)])),
            (4, " ".join(word() for _ in range(200)))]
    docs = spark.createDataFrame([r + (1, "x") for r in rows], "doc_id long, text string, start int, row string")
    found = m.repeated_passages(docs)
    got = {r["doc_id"]: r for r in found.collect()}
    assert set(got) == {2, 3} and all(r["source_doc_id"] == 1 for r in got.values())
    assert (got[2]["start"], got[2]["end"], got[2]["source_start"]) == (2, 82, 30)
    assert abs(got[3]["start"] - 25) <= 1 and abs(got[3]["end"] - 103) <= 1
    left = {r["doc_id"]: r["text"] for r in m.without_passages(docs, found).collect()}
    assert left[1] == rows[0][1] and left[4] == rows[3][1] and left[2] == "Start here\n end  "
    assert m.without_passages(docs, found).columns == docs.columns


def test_hard_rows(spark):
    rnd = random.Random(5)
    hot = " ".join(f"h{rnd.randint(0, 10**6)}" for _ in range(60))
    rows = [(k, hot) for k in range(300)] + [(300, None), (301, ""), (302, "few words only"), (None, hot), (None, None),
                                            (5, hot), (6, hot + " more"), (303, "rep " * 20000), (304, "rep " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = m.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == {*range(1, 300)}  # one word over and over is one seed: no chain
    assert all(r["source_doc_id"] == 0 for r in got)
    assert len([r for r in got if r["doc_id"] == 6]) == 2  # one a text
    left = m.without_passages(docs, m.repeated_passages(docs))
    assert left.where("doc_id between 1 and 5 and text <> ''").count() == 0 and left.count() == docs.count()
    assert m.repeated_passages(docs.limit(0)).count() == 0


def test_passage_twice_in_a_later_document(spark):
    rnd = random.Random(6)
    word = lambda: f"w{rnd.randint(0, 10**6)}"
    some = lambda n: [word() for _ in range(n)]
    passage = some(60)
    rows = [(1, some(30) + passage + some(20)), (2, passage[20:28] + some(40) + passage + some(50) + passage + some(10)),
            (3, passage * 3)]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    left = {r["doc_id"]: r["text"].split() for r in m.without_passages(docs, m.repeated_passages(docs)).collect()}
    assert left == {1: rows[0][1], 2: rows[1][1][:48] + rows[1][1][108:158] + rows[1][1][218:], 3: []}


def test_fuzzy_passages_of_all_degrees(spark):
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randint(0, 10**9)}"
    some = lambda n: [word() for _ in range(n)]
    rows, want = [], set()
    for k, (n, every) in enumerate([(n, every) for n in (60, 80) for every in (20, 14, 10, 8)] * 5):
        passage = some(n)
        changed = [word() if i % every == every - 1 else w for i, w in enumerate(passage)]
        rows += [(k, some(40) + passage + some(60)), (100 + k, some(50) + changed + some(30))]
        want.update((100 + k, i) for i in range(50, 50 + n))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = m.repeated_passages(docs).collect()
    got = {(r["doc_id"], i) for r in found for i in range(r["start"], r["end"])}
    assert all(r["source_doc_id"] == r["doc_id"] - 100 for r in found)
    assert len(want & got) >= 0.95 * len(want)


def test_passage_whose_seeds_first_stand_elsewhere(spark):
    """Every six words of a passage stand in an earlier document of their own."""
    rnd = random.Random(10)
    word = lambda: f"w{rnd.randint(0, 10**9)}"
    some = lambda n: [word() for _ in range(n)]
    passage = some(60)
    fuzzy = [word() if i % 20 == 19 else w for i, w in enumerate(passage)]
    rows = [(i, some(20) + passage[i:i + 6] + some(20)) for i in range(55)]
    rows += [(105, some(30) + passage + some(20)), (109, some(10) + passage + some(40)), (111, some(25) + fuzzy + some(15))]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["source_doc_id"], r["start"], r["end"]) for r in m.repeated_passages(docs).collect()}
    assert got == {109: (105, 10, 70), 111: (105, 25, 84)}


def test_runs_of_seeds():
    rnd = np.random.default_rng(11)
    run = rnd.integers(0, 2**64, 60, dtype=np.uint64)
    a, b = (np.concatenate([rnd.integers(0, 2**64, n, dtype=np.uint64), run, rnd.integers(0, 2**64, 9, dtype=np.uint64)]) for n in (31, 5))
    found = []
    for hashes in (a, b):
        p, h = m.seeds_of(hashes, S)
        i, key, span = m.runs_of(p, h, 40, S)
        assert (span + S.k >= 40).all() and (span + S.k < 40 + S.window).all()
        found.append({int(x): (int(at), int(far)) for x, at, far in zip(key, p[i], span)})
    both = found[0].keys() & found[1].keys()
    assert both and all(found[0][x] == (found[1][x][0] + 26, found[1][x][1]) for x in both)
    assert not len(m.runs_of(np.arange(50), np.full(50, 7, np.uint64), 40, S)[0])
    assert not len(m.runs_of(np.empty(0, np.int64), np.empty(0, np.uint64), 40, S)[0])


def test_thinned_matches_keep_every_diagonal():
    rnd = np.random.default_rng(12)
    for _ in range(200):
        runs = [(int(rnd.integers(0, 900)), int(rnd.integers(0, 900)), int(rnd.integers(1, 120))) for _ in range(int(rnd.integers(1, 6)))]
        p, q = np.unique(np.concatenate([np.stack([a + np.arange(0, n, 2), b + np.arange(0, n, 2)]) for a, b, n in runs], axis=1), axis=1)
        keep = m.thinned(p, q, 20)
        full, few = {}, {}
        for x, y in zip(p.tolist(), q.tolist()):
            full.setdefault(y - x, []).append(x)
        for x, y in zip(p[keep].tolist(), q[keep].tolist()):
            few.setdefault(y - x, []).append(x)
        for line, places in full.items():
            places, kept = sorted(places), sorted(few[line])
            assert kept[0] == places[0] and kept[-1] == places[-1] and set(kept) <= set(places)
            # every match lies near a kept one, on either side unless it is an end of its run
            assert all(min(abs(x - k) for k in kept) <= 20 for x in places)
            runs_kept = sum(b - a > 20 for a, b in zip(kept, kept[1:]))
            assert runs_kept <= sum(b - a > 20 for a, b in zip(places, places[1:])) + 2 * len(kept)


def test_passages_longer_than_the_blocks_around_their_seeds(spark, monkeypatch):
    """Only the middle of a long copy has seeds of its source; its ends are found by growing."""
    monkeypatch.setattr(m, "MARGIN", 16)
    rnd = random.Random(13)
    some = lambda n: [f"w{rnd.randint(0, 10**9)}" for _ in range(n)]
    copy = some(2400)
    rows = [(1, copy[:1100] + some(30)), (2, copy[1200:] + some(30)), (5, some(300) + copy + some(200)), (7, some(40) + copy + some(10))]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["source_doc_id"]): (r["start"], r["end"], r["source_start"], r["source_end"])
           for r in m.repeated_passages(docs).collect()}
    assert got[7, 5] == (40, 2440, 300, 2700) and got[5, 1] == (300, 1400, 0, 1100) and got[5, 2] == (1500, 2700, 0, 1200)


def test_share_of_pieces_that_stand_elsewhere(spark):
    """Passages of 80 words of which every n-th word is changed, and of whose six-word pieces
    a share stands in earlier documents of their own."""
    rnd = random.Random(14)
    some = lambda n: [f"w{rnd.randint(0, 10**9)}" for _ in range(n)]
    share_found = {}
    for held in (0.0, 0.5, 1.0):
        rows, want, at = [], {}, 0
        for every in (20, 10, 8):
            for _ in range(12):
                passage = some(80)
                for i in range(75):
                    if rnd.random() < held:
                        rows.append((at, some(8) + passage[i:i + 6] + some(8)))
                        at += 1
                changed = [f"c{rnd.randint(0, 10**9)}" if i % every == every - 1 else w for i, w in enumerate(passage)]
                rows += [(at, some(20) + passage + some(20)), (at + 1, some(25) + changed + some(15))]
                want[at + 1] = every
                at += 2
        docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
        words_found = {}
        for r in m.repeated_passages(docs).where(f"source_doc_id = doc_id - 1").collect():
            words_found.setdefault(r["doc_id"], set()).update(range(max(25, r["start"]), min(105, r["end"])))
        for every in (20, 10, 8):
            own = [d for d, e in want.items() if e == every]
            share_found[held, every] = sum(len(words_found.get(d, ())) for d in own) / (80 * len(own))
    print({k: round(v, 2) for k, v in share_found.items()})
    assert all(v >= 0.9 for (held, every), v in share_found.items() if held < 1 or every > 8), share_found


def test_seeds_of_many_texts_are_those_of_each():
    rnd = np.random.default_rng(15)
    for _ in range(60):
        texts = [rnd.integers(0, 6 if rnd.random() < 0.3 else 2**64, int(rnd.choice([0, 1, 3, 4, 5, 6, 7, 8, 30])), dtype=np.uint64)
                 for _ in range(int(rnd.integers(0, 12)))]
        text, at, h = m.seeds_of_many(texts, S)
        for k, x in enumerate(texts):
            p, own = m.seeds_of(x, S)
            assert at[text == k].tolist() == p.tolist() and h[text == k].tolist() == own.tolist()


def test_chains_on_one_line_equal_those_of_the_tree():
    rnd = random.Random(16)
    for _ in range(300):
        n = rnd.randint(2, 30)
        places = sorted(rnd.sample(range(900), n))
        p = np.array(places)
        q = p + 7 if n > 2 else np.array([rnd.randint(0, 60), rnd.randint(0, 60)])
        odd = m.Settings(gap_cost=0.0501)  # no gap costs just what a seed gains: there the tree's rounding decides
        fast = [x.tolist() for x in m.chains(p, q, odd)]
        # a match far off the line, which joins none, sends them through the tree
        slow = [x.tolist() for x in m.chains(np.append(p, 10**6), np.append(q, -10**6), odd) if n not in x.tolist()]
        assert sorted(fast) == sorted(slow)


def test_first_places_are_found_by_spark_alone(spark):
    rnd = random.Random(12)
    rows = [(rnd.randint(-9, 9), rnd.randint(-4, 9), rnd.randint(0, 2), rnd.randint(0, 30)) for _ in range(400)] + [(77, 1, 0, 5)] * 3
    met = m._met(spark.createDataFrame(rows, "seed long, doc_id long, row int, at int"))
    first = {s: min(r[1:] for r in rows if r[0] == s) for s, *_ in rows}
    want = [r + first[r[0]] for r in rows if len({x[1] for x in rows if x[0] == r[0]}) > 1]
    assert met.columns == ["seed", "doc_id", "row", "at", "d0", "r0", "at0"]
    assert sorted(tuple(r) for r in met.collect()) == sorted(want)
    assert "MapInArrow" not in met._jdf.queryExecution().executedPlan().toString()


def test_runs_of_many_documents_stay_in_their_own():
    rnd = random.Random(13)
    docs = []
    for _ in range(60):
        p = np.unique([rnd.randint(0, 120) for _ in range(rnd.randint(1, 60))])
        docs.append((p, np.array([rnd.randint(0, 3) for _ in p], np.uint64)))
    far = S.least_words + S.window
    shift = np.cumsum([0] + [p[-1] + far for p, _ in docs[:-1]])
    flat, hashes = (np.concatenate(x) for x in ([p + k for (p, _), k in zip(docs, shift)], [h for _, h in docs]))
    for least in (S.between, S.least_words):
        i, key, span = m.runs_of(flat, hashes, least, S)
        got = sorted(zip((flat[i] - np.repeat(shift, [len(p) for p, _ in docs])[i]).tolist(), key.tolist(), span.tolist()))
        want = []
        for p, h in docs:
            k, own, far_off = m.runs_of(p, h, least, S)
            want += zip(p[k].tolist(), own.tolist(), far_off.tolist())
        assert got == sorted(want)


def test_matches_of_several_groups_are_thinned_apart():
    rnd = random.Random(14)
    group = np.sort([rnd.randint(0, 5) for _ in range(200)])
    p, q = (np.array([rnd.randint(0, 40) for _ in group]) for _ in range(2))
    parts = [np.flatnonzero(group == g) for g in np.unique(group)]
    assert m.thinned(p, q, 8, group).tolist() == [i for x in parts for i in x[m.thinned(p[x], q[x], 8)].tolist()]
