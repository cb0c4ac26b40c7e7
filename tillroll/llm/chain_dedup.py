"""Substring dedup by collinear chaining of shared k-mers.

Seeds are hashed runs of ``k`` words, thinned to the smallest hash of each window of
places (so any shared run of ``k + window - 1`` words shares a seed).  A seed that
stands in several documents joins each of its places to its first one only, at its first
place there - a star, linear in the seed's frequency.  Runs of neighbouring seeds, of about
``between`` and of ``least_words`` words, do the same as wholes: a passage whose seeds
first stand elsewhere, in several documents, meets the first one that holds it.  The seeds that a document shares with an earlier one
are chained in order of place on both sides; a Fenwick tree over places in the earlier
document gives the best predecessor under a linear gap cost.  Matches of
one diagonal are thinned first.  Chains are extended and aligned word by word: a chain
meets the blocks of words of its source around it, and the whole source only if it grows beyond
them.  Aligned passages that are long and alike enough are reported with their place in
both documents."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.shingles import mix, windows, word_hashes_of, words
from tillroll.llm.store import drop_stored, fresh_name, if_few, rewritten, stored, tidy


_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_WORD = re.compile("[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Settings:
    k: int = 4                # words of a seed
    window: int = 4           # places of which one seed is kept
    least_seeds: int = 2      # of a chain
    least_words: int = 40     # of a passage
    least_alike: float = 0.8  # words aligned, of the longer side
    gap_cost: float = 0.05    # a word skipped, on either side
    between: int = 7          # words of the shorter runs of seeds
    drop: int = 6             # extension stops when the score falls so far below its best


def seeds_of(hashes: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept seeds of a text (leftmost smallest of each window)."""
    h = windows(hashes, s.k)
    if not len(h):
        return np.empty(0, np.int64), h
    order = mix(h)  # smallest by another mixing, so common words don't decide
    if len(h) <= s.window:
        at = np.array([order.argmin()])
    else:
        view = np.lib.stride_tricks.sliding_window_view(order, s.window)
        at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return at, h[at]


def seeds_of_many(texts: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of the kept seeds of several texts: ``seeds_of`` each."""
    sizes = np.array([len(x) for x in texts], np.int64)
    flat = np.concatenate(texts) if len(texts) else np.empty(0, np.uint64)
    none = np.empty(0, np.int64)
    h = windows(flat, s.k)
    if not len(h):
        return none, none, h
    starts = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)[:len(h)]
    left = starts[text] + sizes[text] - s.k - np.arange(len(h))  # places after this one in its text; < 0: none here
    order = np.where(left >= 0, mix(h), np.uint64(2**64 - 1))
    n = len(h) - s.window + 1
    at = [none]
    if n > 0:
        best, low = np.arange(n), order[:n].copy()
        for j in range(1, s.window):
            smaller = order[j:j + n] < low
            best[smaller] += (np.arange(n) + j - best)[smaller]
            low = np.where(smaller, order[j:j + n], low)
        at.append(best[left[:n] >= s.window - 1])
    for k in np.flatnonzero((sizes >= s.k) & (sizes - s.k + 1 <= s.window)):  # texts of one window at most
        at.append(starts[k:k + 1] + order[starts[k]:starts[k] + sizes[k] - s.k + 1].argmin())
    kept = np.zeros(len(h), bool)
    kept[np.concatenate(at)] = True
    at = np.flatnonzero(kept)
    return text[at], at - starts[text[at]], h[at]


def runs_of(p: np.ndarray, h: np.ndarray, least: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the first seed, hash, distance of the last one) of the shortest run from
    each seed on that holds ``least`` words without a gap of more than ``window`` places;
    of one seed over and over, none."""
    end = np.searchsorted(p, p + (least - s.k))
    i = np.flatnonzero(end < len(p))
    j = end[i]
    changes = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))[:len(h)]
    steps = np.diff(p, prepend=p[:1]).astype(np.uint64)
    breaks = np.cumsum(steps > s.window)
    some = (changes[j] > changes[i]) & (breaks[j] == breaks[i])
    i, j = i[some], j[some]
    power = np.cumprod(np.full(len(p), _BASE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ mix(steps + _BASE)) * power)])
    inside = (total[j + 1] - total[i + 1]) * np.cumprod(np.full(len(p), _INVERSE, np.uint64))[i]
    return i, mix(inside + mix(h[i]) + np.uint64(least)), p[j] - p[i]


def _one_line(p: list[int], q: list[int], s: Settings) -> tuple[list[float], list[int]]:
    """Score and predecessor of two matches, or of matches on one diagonal, in order of
    place: none but the one before can be the best predecessor."""
    score, back = [float(s.k)] * len(p), [-1] * len(p)
    for i in range(1, len(p)):
        gain = score[i - 1] - s.gap_cost * (p[i] - p[i - 1] + q[i] - q[i - 1])
        if gain > 0 and p[i] > p[i - 1] and q[i] > q[i - 1]:
            score[i], back[i] = s.k + gain, i - 1
    return score, back


def _by_tree(p: list[int], q: list[int], ranks: list[int], s: Settings) -> tuple[list[float], list[int]]:
    """Score and best predecessor of each match, in order of place."""
    n, size = len(p), max(ranks)
    tree = [(-np.inf, -1)] * (size + 1)   # best (score + cost of its place, match) by prefix
    score, back = [0.0] * n, [-1] * n
    start = 0
    while start < n:
        end = start
        while end < n and p[end] == p[start]:
            end += 1
        for i in range(start, end):   # matches at one place can't follow each other
            best, r = (-np.inf, -1), ranks[i] - 1
            while r:
                if tree[r] > best:
                    best = tree[r]
                r &= r - 1
            gain = best[0] - s.gap_cost * (p[i] + q[i])
            score[i] = s.k + max(gain, 0.0)
            if gain > 0:
                back[i] = best[1]
        for i in range(start, end):
            entry, r = (score[i] + s.gap_cost * (p[i] + q[i]), i), ranks[i]
            while r <= size:
                if entry > tree[r]:
                    tree[r] = entry
                r += r & -r
        start = end
    return score, back


def _in_order(p: list[int], q: list[int], straight: bool, s: Settings) -> list[list[int]]:
    """``chains`` of matches in order of place; ``straight``: all lie on one diagonal."""
    n = len(p)
    if n == 1:
        return [[0]]
    if n == 2 or straight:
        score, back = _one_line(p, q, s)
    else:
        rank = {x: k for k, x in enumerate(sorted(set(q)), 1)}
        score, back = _by_tree(p, q, [rank[x] for x in q], s)
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda x: (-score[x], x)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def chains(p: np.ndarray, q: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Collinear chains of matches (place ``p`` here, ``q`` there), each as indices in
    order.  Best chains first; every match is in one chain at most."""
    order = np.lexsort((q, p))
    p, q = p[order], q[order]
    return [order[c] for c in _in_order(p.tolist(), q.tolist(), bool((q - p == q[:1] - p[:1]).all()), s)]


def _extend(a: list, b: list, i: int, j: int, step: int, s: Settings, ends: set | None = None) -> int:
    """Words by which a passage grows from a[i], b[j] on in direction ``step``: +1 a
    word that agrees, -2 one that doesn't, up to the best sum.  ``ends`` gets the direction
    if nothing but the end of ``b`` stopped it."""
    total = best = far = n = 0
    while 0 <= i < len(a) and 0 <= j < len(b) and total > best - s.drop:
        total += 1 if a[i] == b[j] else -2
        n += 1
        if total > best:
            best, far = total, n
        i, j = i + step, j + step
    if ends is not None and 0 <= i < len(a) and total > best - s.drop:
        ends.add(step)
    return far


def aligned(a: list, b: list) -> int:
    """Words that a global alignment of two passages matches (their longest common
    subsequence, by one integer of bits a word of ``a``)."""
    at: dict = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _seeds(docs: DataFrame, s: Settings) -> DataFrame:
    """(seed, doc_id, row, at): one row a kept place."""
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                b = batch.slice(begin, 256)
                doc, row = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
                text, at, h = seeds_of_many(word_hashes_of(b.column(1).to_pylist()), s)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc[text].astype(np.int64)),
                                                  pa.array(row[text].astype(np.int32)), pa.array(at.astype(np.int32))], _PLACE)

    return docs.select("doc_id", "text", "row").mapInArrow(run, "seed long, doc_id long, row int, at int")


_PLACE = ["seed", "doc_id", "row", "at"]


def _met(places: DataFrame) -> DataFrame:
    """Those places of seeds (or of runs) that several documents hold, each with the
    first place of the smallest document (d0, r0, at0)."""
    held = Window.partitionBy("seed").orderBy("doc_id", "row", "at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = {"d0": "doc_id", "r0": "row", "at0": "at"}
    return (places.select("*", *[F.first(x).over(held).alias(name) for name, x in firsts.items()], F.last("doc_id").over(held).alias("top"))
            .where("top > d0").drop("top"))


def _runs(places: DataFrame, s: Settings) -> DataFrame:
    """Runs of the seeds in ``places`` (_met), as places themselves.  A run that several
    documents hold has no seed that stands in one alone."""
    far = s.least_words + s.window  # between the places of two documents, so no run leaves one

    def made(cols: list[np.ndarray]) -> pa.RecordBatch:
        doc, row, at, seed = (x[_changes(*cols[:3])] for x in cols)  # equal rows have equal places
        new = _changes(doc, row)
        last = np.concatenate([[0], at[:-1]])
        p = at + np.cumsum(np.where(new, last + far, 0))
        h, parts = seed.view(np.uint64), []
        for least in (s.between, s.least_words):
            i, key, span = runs_of(p, h, least, s)
            parts.append((key.view(np.int64), doc[i], row[i], at[i], span))
        flat = [np.concatenate(x) for x in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32) if k > 1 else x) for k, x in enumerate(flat)], [*_PLACE, "span"])

    def run(batches):
        held = [np.empty(0, np.int64)] * 4  # the last document's
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([x, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k, x in enumerate(held)]
            same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            whole = int(same.argmax())
            if whole:
                yield made([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if len(held[0]):
            yield made(held)

    return (places.select("doc_id", "row", "at", "seed").repartition("doc_id", "row").sortWithinPartitions("doc_id", "row", "at")
            .mapInArrow(run, "seed long, doc_id long, row int, at int, span int"))


def thinned(p: np.ndarray, q: np.ndarray, step: int, group: np.ndarray | None = None) -> np.ndarray:
    """Indices of the matches that stand for all: of matches on one diagonal (of one
    ``group``) that follow each other by ``step`` words at most, the first, the last and one
    every ``step`` words."""
    group = np.zeros(len(p), np.int64) if group is None else group
    order = np.lexsort((p, q - p, group))
    a, line, group = p[order], (q - p)[order], group[order]
    new = np.r_[True, (np.diff(line) != 0) | (np.diff(group) != 0) | (np.diff(a) > step)]
    first = np.flatnonzero(new)
    begin = a[first][np.cumsum(new) - 1]
    keep = new | np.r_[new[1:], True] | np.r_[True, np.diff((a - begin) // step) != 0]
    return np.sort(order[keep])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Whether each row differs from the one before it; the first does."""
    return np.concatenate([np.ones(min(1, len(columns[0])), bool), np.any([x[1:] != x[:-1] for x in columns], axis=0)])


def _chained(shared: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, row, matches) → (doc_id, row, d0, r0, found): chains per earlier
    document, best first, each as its seeds' places here and there."""
    # a step of so many words between matches on one diagonal costs half of what a seed gains
    step = max(s.k, int(s.k / (4 * s.gap_cost)))

    def matches_of(b: pa.RecordBatch) -> list[np.ndarray]:
        """(row of ``b``, d0, r0, at, at0) of all its matches, in this order, each once."""
        lists = b.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        d0, r0, at, at0, span = (flat.field(x).to_numpy().astype(np.int64) for x in ("d0", "r0", "at", "at0", "span"))
        k = np.repeat(np.arange(b.num_rows), sizes)
        run = span > 0  # its first and its last seed
        cols = [np.concatenate([x, x[run]]) for x in (k, d0, r0)] + [np.concatenate([x, x[run] + span[run]]) for x in (at, at0)]
        order = np.lexsort(cols[::-1])
        cols = [x[order] for x in cols]
        once = _changes(*cols)
        return [x[once] for x in cols]

    def made(b: pa.RecordBatch) -> pa.RecordBatch:
        docs, at_row = (b.column(x).to_numpy() for x in (0, 1))
        cols = matches_of(b)
        rows = []
        if len(cols[0]):
            source = np.cumsum(_changes(*cols[:3])) - 1
            some = (np.bincount(source) >= s.least_seeds)[source]
            cols, source = [x[some] for x in cols], source[some]
        if len(cols[0]):
            keep = thinned(*cols[3:], step, source)
            k, d0, r0, at, at0 = (x[keep] for x in cols)
            starts = np.flatnonzero(_changes(source[keep]))
            ends = np.r_[starts[1:], len(keep)]
            bent = np.concatenate([[0], np.cumsum(np.diff(at0 - at) != 0)])
            straight = bent[ends - 1] == bent[starts]
            firsts = (x[starts].tolist() for x in (docs[k], at_row[k], d0, r0))
            at, at0 = at.tolist(), at0.tolist()
            for x, y, line, *names in zip(starts.tolist(), ends.tolist(), straight.tolist(), *firsts):
                p, q = at[x:y], at0[x:y]
                found = [{"at": [p[i] for i in c], "at0": [q[i] for i in c]} for c in _in_order(p, q, line, s) if len(c) >= s.least_seeds]
                if found:
                    rows.append((*names, found))
        made = list(zip(*rows)) or [()] * 5
        chain = pa.list_(pa.struct([("at", pa.list_(pa.int32())), ("at0", pa.list_(pa.int32()))]))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(made, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), chain))],
                                          ["doc_id", "row", "d0", "r0", "found"])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                yield made(batch.slice(begin, 256))

    return shared.mapInArrow(run, "doc_id long, row int, d0 long, r0 int, "
                                  "found array<struct<at:array<int>,at0:array<int>>>")


def passages_of(here: list, there: list, at: list[int], at0: list[int], s: Settings,
                ends: set | None = None) -> list[tuple[int, ...]]:
    """(start, end, start0, end0, words aligned) of the alike stretches of a chain.  A
    chain that isn't alike as a whole is split at its widest gap.  ``ends``: see ``_extend``."""
    out, todo = [], [(0, len(at))]
    while todo:
        i, j = todo.pop()
        if j - i < s.least_seeds or any(a <= at[i] and at[j - 1] + s.k <= b for a, b, *_ in out):
            continue
        left = _extend(here, there, at[i] - 1, at0[i] - 1, -1, s, ends)
        right = _extend(here, there, at[j - 1] + s.k, at0[j - 1] + s.k, 1, s, ends)
        a, b, c, d = at[i] - left, at[j - 1] + s.k + right, at0[i] - left, at0[j - 1] + s.k + right
        longer = max(b - a, d - c)
        if longer < s.least_words:
            continue
        same = b - a if here[a:b] == there[c:d] else \
            aligned(here[a:b], there[c:d]) if min(b - a, d - c) >= s.least_alike * longer else 0
        if same >= s.least_alike * longer:
            out.append((a, b, c, d, same))
            continue
        cut = max(range(i + 1, j), key=lambda x: max(at[x] - at[x - 1], at0[x] - at0[x - 1])
                  + abs(at[x] - at[x - 1] - at0[x] + at0[x - 1]))
        todo += [(i, cut), (cut, j)]
    return out


#: Words of a document that travel as one row, and those asked for around a chain.
BLOCK_WORDS, MARGIN = 128, 64


def _blocks_of(docs: DataFrame) -> DataFrame:
    """(d0, r0, block, words, all): texts in blocks of words; ``all``: the text's words."""
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                b, rows = batch.slice(begin, 256), ([], [], [], [], [])
                for doc, text, row in zip(*(b.column(k).to_pylist() for k in range(3))):
                    w = words(text)
                    for at in range(0, len(w), BLOCK_WORDS):
                        for held, x in zip(rows, (doc, row, at // BLOCK_WORDS, b" ".join(w[at:at + BLOCK_WORDS]), len(w))):
                            held.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()))],
                                                 ["d0", "r0", "block", "words", "all"])

    return docs.select("doc_id", "text", "row").mapInArrow(run, "d0 long, r0 int, block int, words binary, all int")


_FOUND = "start int, end int, source_start int, source_end int, n_aligned int"


def _passages(pairs: DataFrame, s: Settings) -> DataFrame:
    """Aligns the chains of (doc_id, row, text, sources array of (d0, r0, found), blocks array
    of (d0, r0, block, words, all)): (doc_id, row, d0, r0, passages, cut); ``cut``: nothing
    but the end of the blocks that are here stopped a passage, and the earlier text goes
    on, so more of it is needed."""
    kind = pa.struct([(x.split()[0], pa.int32()) for x in _FOUND.split(", ")])

    def aligned_with(here: list[bytes], found: list[dict], blocks: dict[int, bytes], size: int) -> tuple[list, bool]:
        rows, done, cut, ready = [], [], False, {}
        for x in found:
            if any(a <= x["at"][0] and x["at"][-1] + s.k <= b for a, b in done):
                continue  # within a passage already found in this document
            first, last = x["at0"][0] // BLOCK_WORDS, (x["at0"][-1] + s.k - 1) // BLOCK_WORDS
            while first - 1 in blocks:
                first -= 1
            while last + 1 in blocks:
                last += 1
            if (first, last) not in ready:
                ready = {(first, last): b" ".join([blocks[k] for k in range(first, last + 1)]).split()}
            there = ready[first, last]
            offset, ends = first * BLOCK_WORDS, set()
            for a, b, c, d, same in passages_of(here, there, x["at"], [y - offset for y in x["at0"]], s, ends):
                done.append((a, b))
                rows.append({"start": a, "end": b, "source_start": c + offset, "source_end": d + offset, "n_aligned": same})
            cut = cut or (-1 in ends and offset > 0) or (1 in ends and offset + len(there) < size)
        return rows, cut

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 32):
                part, rows = batch.slice(begin, 32), []
                for doc, row, text, sources, parts in zip(*(part.column(j).to_pylist() for j in range(5))):
                    here = words(text)
                    blocks: dict = {}
                    for x in parts:
                        blocks.setdefault((x["d0"], x["r0"]), ({}, x["all"]))[0][x["block"]] = x["words"]
                    for source in sources:
                        found, cut = aligned_with(here, source["found"], *blocks[source["d0"], source["r0"]])
                        if found or cut:
                            rows.append((doc, row, source["d0"], source["r0"], found, cut))
                cols = list(zip(*rows)) or [()] * 6
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(kind), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], ["doc_id", "row", "d0", "r0", "passages", "cut"])

    return pairs.select("doc_id", "row", "text", "sources", "blocks").mapInArrow(
        run, f"doc_id long, row int, d0 long, r0 int, passages array<struct<{_FOUND.replace(' int', ':int')}>>, cut boolean")


def _aligned(found: DataFrame, docs: DataFrame, blocks: DataFrame, whole: bool, s: Settings) -> DataFrame:
    """The passages of ``found`` (chains): each chain meets the blocks of its source around it
    (or all), which go to the document's text once."""
    source = ["d0", "r0"]
    if whole:
        asked = stored(found.select("doc_id", "row", *source).distinct(), "chain-asked")
        met = blocks.join(if_few(asked), source)
    else:
        block = lambda x: F.floor(x / BLOCK_WORDS).cast("int")
        begin, end = F.element_at(F.col("c.at0"), 1) - MARGIN, F.element_at(F.col("c.at0"), -1) + MARGIN + s.k
        asked = found.select("doc_id", "row", *source, F.explode("found").alias("c")).select(
            "doc_id", "row", *source, F.explode(F.sequence(block(F.greatest(begin, F.lit(0))), block(end))).alias("block"))
        asked = stored(asked.distinct(), "chain-asked")
        met = blocks.join(if_few(asked), [*source, "block"])
    parts = met.groupBy("doc_id", "row").agg(F.collect_list(F.struct(*source, "block", "words", "all")).alias("blocks"))
    sources = found.groupBy("doc_id", "row").agg(F.collect_list(F.struct(*source, "found")).alias("sources"))
    texts = docs.select("doc_id", "row", "text").dropDuplicates(["doc_id", "row"])
    return _passages(texts.join(sources, ["doc_id", "row"]).join(parts, ["doc_id", "row"]), s)


def row_key(text_col: str = "text"):
    """What tells rows of one id apart: a hash of the text."""
    return F.xxhash64(F.col(text_col).cast("string"))


def repeated_passages(docs: DataFrame, settings: Settings = Settings(),
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, start, end, source_doc_id, source_row, source_start, source_end,
    n_aligned): passages of words ``start .. end - 1`` of a document that repeat, exactly
    or nearly, words of one with a smaller id; a passage's first copy is only a source.

    Words are ``[^\\\\x20\\\\x09-\\\\x0D]+`` with A-Z in lower case.  Repeats within one document
    are not passages.  Texts of fewer than ``k`` words, null and empty ones have no seeds;
    rows without an id are not compared.  Rows that share an id are not compared with each
    other; ``row`` (``row_key``) tells their texts apart, and wholly equal rows have the
    same passages.  An empty table gives an empty one; other columns are not read."""
    s = settings
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       row_key(text_col).alias("hash")).where("doc_id is not null")
    docs, ranks = _ranked(docs)
    spark = docs.sparkSession
    seeds = stored(_met(_seeds(docs, s)), "seeds-shared")
    tidy(spark)
    runs = stored(_met(_runs(seeds, s)).where("doc_id > d0").drop("seed"), "runs-shared")
    tidy(spark)
    # equal rows give equal seeds, so each is one document here
    shared = (seeds.where("doc_id > d0").drop("seed").withColumn("span", F.lit(0)).unionByName(runs)
              .groupBy("doc_id", "row").agg(F.collect_set(F.struct("d0", "r0", "at", "at0", "span")).alias("matches")))
    found = stored(_chained(shared, s), "chains")
    drop_stored(seeds, runs)
    tidy(spark)
    used = stored(found.select(F.col("d0").alias("doc_id"), F.col("r0").alias("row")).distinct(), "chain-sources")
    texts = docs.select("doc_id", "row", "text")
    blocks = stored(_blocks_of(texts.join(if_few(used), ["doc_id", "row"], "left_semi").dropDuplicates(["doc_id", "row"])), "chain-blocks")
    later = stored(found.select("doc_id", "row").distinct(), "chain-docs")
    tidy(spark)
    needed = texts.join(if_few(later), ["doc_id", "row"], "left_semi")
    first = stored(_aligned(found, needed, blocks, False, s), "passages")
    pair = ["doc_id", "row", "d0", "r0"]
    tidy(spark)
    again = found.join(stored(first.where("cut").select(*pair), "passages-cut"), pair, "left_semi")
    whole = stored(_aligned(again, needed, blocks, True, s), "passages-whole")
    drop_stored(blocks, found)
    tidy(spark)
    out = first.where("not cut").union(whole).select(*pair, F.inline("passages"))
    return _named(out, ranks)


def _ranked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``row``, the rank of a text among those of its id (0: the only one),
    in place of its hash, and the table of (doc_id, hash, row)."""
    names = stored(docs.select("doc_id", "hash").distinct(), "chain-ids")
    several = stored(names.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes")).where("size(hashes) > 1")
                     .select("doc_id", F.posexplode(F.array_sort("hashes")).alias("row", "hash")), "chain-rows")
    ranks = names.join(if_few(several), ["doc_id", "hash"], "left").withColumn("row", F.coalesce("row", F.lit(0)))
    return docs.join(if_few(several), ["doc_id", "hash"], "left").select("doc_id", "text", F.coalesce("row", F.lit(0)).alias("row")), ranks


def _named(passages: DataFrame, ranks: DataFrame) -> DataFrame:
    here = ranks.select("doc_id", "row", F.col("hash").alias("own"))
    there = ranks.select(F.col("doc_id").alias("d0"), F.col("row").alias("r0"), F.col("hash").alias("source_row"))
    return (passages.join(here, ["doc_id", "row"]).join(there, ["d0", "r0"])
            .select("doc_id", F.col("own").alias("row"), "start", "end", F.col("d0").alias("source_doc_id"), "source_row",
                    "source_start", "source_end", "n_aligned"))


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep_emptied: bool = True) -> DataFrame:
    """``docs`` with the words of ``passages`` taken out of the texts (blanks between the
    remaining words stay); documents without passages stay as they are.  Unless
    ``keep_emptied``, documents of which no word is left go."""
    names = docs.columns
    id_key, key, spans = (fresh_name(names, x) for x in ("_id", "_row", "_spans"))
    cuts = passages.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end")).alias(spans)) \
        .select(F.col("doc_id").alias(id_key), F.col("row").alias(key), spans)

    def left(text: str, found: list[dict]) -> str | None:
        gone: list[list[int]] = []
        for a, b in sorted((x["start"], x["end"]) for x in found):
            if gone and a <= gone[-1][1]:
                gone[-1][1] = max(gone[-1][1], b)
            else:
                gone.append([a, b])
        out, at, k = [], 0, 0
        for word, m in enumerate(_WORD.finditer(text)):  # a word goes or stays with the blanks before it
            while k < len(gone) and gone[k][1] <= word:
                k += 1
            if k == len(gone) or word < gone[k][0]:
                out.append(text[at:m.end()])
            at = m.end()
        return "".join(out) + text[at:] if out or keep_emptied else None

    joined = docs.join(cuts, (docs[id_col] == cuts[id_key]) & (row_key(text_col) == cuts[key]), "left")
    return rewritten(joined.select(*names, spans), text_col, left)
