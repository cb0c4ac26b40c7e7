"""Line dedup by a segment-partition edit join.

A line of length n is cut into threshold + 1 even segments.  If another line, not
shorter, is within the threshold, one segment stands in it unchanged near its own
place, so it is found among few substrings: for each length n - threshold .. n the
other line probes the segments of such lines at the places that the two lengths
allow.  Candidates are verified by a banded bit-parallel edit distance.

Equal lines meet by hash before any segment is made.  Segments and probes carry a
line's hash and parities only; a task compares those under one key and passes on the
lines that may have a partner, never pairs.  These are fetched as text and meet once
more under their key in order of place, where a line is done with the first earlier one
found near it: rows grow with the lines, however many are alike."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import fresh_name, if_few, rewritten, stored
from tillroll.llm.worker_memory import claim

BLANKS = " \t\n\x0b\x0c\r"


def within(a: str, b: str, threshold: int) -> bool:
    """Edit distance of two strings at most ``threshold``: one word of 2 * threshold + 1
    diagonals per number of errors, moved along ``b`` a character at a time."""
    if abs(len(a) - len(b)) > threshold:
        return False
    band = (1 << (2 * threshold + 1)) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    places = {c: m << threshold for c, m in places.items()}
    # bit d of state[e]: the first j of b match the first j + d - threshold of a with e errors
    state = [((2 << e) - 1) << threshold & band for e in range(threshold + 1)]
    for j, c in enumerate(b):
        same = places.get(c, 0) >> j
        old, state[0] = state[0], state[0] & same
        for e in range(1, threshold + 1):
            now = state[e] & same | old | old >> 1 | state[e - 1] << 1 & band
            old, state[e] = state[e], now & band
        if not state[threshold]:
            return False
    return bool(state[threshold] >> (len(a) - len(b) + threshold) & 1)


def partition(n: int, parts: int) -> list[tuple[int, int]]:
    """Even segments (start, end) of a line of ``n`` characters, short ones first."""
    size, longer = divmod(n, parts)
    starts = [k * size + max(0, k - (parts - longer)) for k in range(parts + 1)]
    return list(zip(starts, starts[1:]))


_CLASS = np.left_shift(np.uint32(1), np.arange(32, dtype=np.uint32))


class _Plan(dict):
    """n → ([(seed, start, end)] of own segments, the same of probed substrings)."""

    def __init__(self, threshold: int, least: int):
        super().__init__()
        self.threshold, self.least = threshold, least

    def __missing__(self, n: int):
        t = self.threshold
        own = [(n << 4 | i, a * 4, b * 4) for i, (a, b) in enumerate(partition(n, t + 1))]
        probes = []
        for m in range(max(self.least, n - t), n + 1):
            for i, (a, b) in enumerate(partition(m, t + 1)):
                # errors left and right of the segment bound how far it can have moved
                low = max(a - i, a + (n - m) - (t - i), 0)
                high = min(a + i, a + (n - m) + (t - i), n - (b - a))
                probes += [(m << 4 | i, p * 4, (p + b - a) * 4) for p in range(low, high + 1)]
        if len(self) > 50_000:
            self.clear()
        self[n] = own, probes
        return self[n]


def lines_of(text: str | None) -> list[str]:
    return text.split("\n") if text is not None else []


def _identity(line: str) -> tuple[int, int]:
    raw = line.encode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest(raw), xxhash.xxh64_intdigest(raw)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _occurrences(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, line_no, row, h1, h2) of every line of at least ``least`` characters."""
    def run(batches):
        claim("lines")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                texts, doc, no, row, h1, h2 = b.column(1), [], [], [], [], []
                for k, (d, r) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
                    for j, line in enumerate(lines_of(texts[k].as_py())):
                        line = line.strip(BLANKS)
                        if len(line) >= least:
                            x, y = _identity(line)
                            doc.append(d)
                            no.append(j)
                            row.append(r)
                            h1.append(x)
                            h2.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(row, pa.int64()),
                                                  _signed(h1), _signed(h2)], ["doc_id", "line_no", "row", "h1", "h2"])

    return docs.mapInArrow(run, "doc_id long, line_no int, row long, h1 long, h2 long")


def _keys(docs: DataFrame, threshold: int, least: int) -> DataFrame:
    """(h1, sketch, keys): hashes of a line's own segments (the first ``threshold`` + 1) and
    of the substrings it probes, once per line and task, and the parities of its
    characters' counts in 32 classes: an edit changes two of them at most."""
    def run(batches):
        claim("lines")
        plan, seen = _Plan(threshold, least), set()
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts, h1, raws, keys, ends = batch.column(1).slice(at, 512), [], [], [], [0]
                for k in range(len(texts)):
                    for line in lines_of(texts[k].as_py()):
                        line = line.strip(BLANKS)
                        if len(line) < least:
                            continue
                        h = digest(line.encode("utf-8", "surrogatepass"))
                        if h in seen:
                            continue
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen.add(h)
                        raw = line.encode("utf-32-le", "surrogatepass")
                        segments, probes = plan[len(line)]
                        h1.append(h)
                        raws.append(raw)
                        keys += [digest(raw[a:b], s) for s, a, b in segments]
                        keys += [digest(raw[a:b], s) for s, a, b in probes]
                        ends.append(len(keys))
                classes = _CLASS[np.frombuffer(b"".join(raws), "<u4") & 31]
                starts = np.cumsum([0] + [len(x) // 4 for x in raws[:-1]])
                sketch = np.bitwise_xor.reduceat(classes, starts) if raws else classes
                yield pa.RecordBatch.from_arrays(
                    [_signed(h1), pa.array(sketch.view(np.int32)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(keys))],
                    ["h1", "sketch", "keys"])

    return docs.mapInArrow(run, "h1 long, sketch int, keys array<long>")


#: Lines that one task compares under one key; more are dealt out anew by parts of their parities.
MANY = 20_000
_MET = ["key", "h1", "sketch", "probe", "many"]


def _partners(sketch: np.ndarray, probe: np.ndarray, line: np.ndarray, threshold: int) -> np.ndarray:
    """Which entries of one key have another line on the other side whose parities are near."""
    out = np.zeros(len(line), bool)
    own, asks = np.flatnonzero(~probe), np.flatnonzero(probe)
    for at in range(0, len(asks), 512):
        p = asks[at:at + 512]
        near = np.bitwise_count(sketch[p, None] ^ sketch[None, own]) <= 2 * threshold
        near &= line[p, None] != line[None, own]
        out[p] |= near.any(axis=1)
        out[own] |= near.any(axis=0)
    return out


def _met(entries: DataFrame, threshold: int, many: int | None) -> DataFrame:
    """The (key, h1, sketch, probe) of ``entries`` that may be near another line under their
    key, each once.  Entries of a key that more than ``many`` have come back as they are."""
    def batch_of(rows, flag):
        key, h, sketch, probe = rows
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(h), pa.array(sketch.view(np.int32)), pa.array(probe),
                                           pa.array(np.full(len(key), flag))], _MET)

    def compared(rows, starts):
        key, h, sketch, probe = rows
        kept = []
        ends = np.r_[starts[1:], len(key)]
        for g in np.flatnonzero(np.minimum.reduceat(h, starts) != np.maximum.reduceat(h, starts)):
            a, b = starts[g], ends[g]
            order = np.lexsort((probe[a:b], h[a:b]))
            first = np.r_[True, (np.diff(h[a:b][order]) != 0) | (np.diff(probe[a:b][order].view(np.int8)) != 0)]
            at = order[first] + a
            if probe[at].all() or not probe[at].any():
                continue
            kept.append(at[_partners(sketch[at], probe[at], h[at], threshold)])
        at = np.concatenate(kept) if kept else np.empty(0, np.int64)
        return batch_of([x[at] for x in rows], False)

    def run(batches):
        held, hot = None, None
        for batch in batches:
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            rows[2] = rows[2].view(np.uint32)
            if hot is not None:
                n = int(np.searchsorted(rows[0], hot, "right"))
                yield batch_of([x[:n] for x in rows], True)
                rows = [x[n:] for x in rows]
                hot = hot if not len(rows[0]) else None
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            starts = np.flatnonzero(np.r_[True, np.diff(rows[0]) != 0])
            last = starts[-1]
            if last:
                yield compared([x[:last] for x in rows], starts[:-1])
            held = [x[last:] for x in rows]
            if many is not None and len(held[0]) > many:
                yield batch_of(held, True)
                held, hot = None, held[0][0]
        if held is not None and len(held[0]):
            yield compared(held, np.zeros(1, np.int64))

    return (entries.select("key", "h1", "sketch", "probe").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "key long, h1 long, sketch int, probe boolean, many boolean"))


def _candidates(docs: DataFrame, threshold: int, least: int) -> DataFrame:
    """(key, h1, sketch, probe): lines that share a segment with a line of near parities."""
    entries = (_keys(docs, threshold, least).select("h1", "sketch", F.posexplode("keys").alias("at", "key"))
               .select("key", "h1", "sketch", (F.col("at") > threshold).alias("probe")))
    met = stored(_met(entries, threshold, MANY), "line-met")
    # parities that differ in 2 * threshold of 32 places agree in one of 2 * threshold + 1 parts
    parts, size = 2 * threshold + 1, -(-32 // (2 * threshold + 1))
    part = F.explode(F.array(*[F.xxhash64("key", F.lit(i), F.shiftrightunsigned("sketch", i * size).bitwiseAND(F.lit((1 << size) - 1)))
                               for i in range(parts) if i * size < 32]))
    finer = met.where("many").select(part.alias("key"), "h1", "sketch", "probe")
    return met.where("not many").drop("many").union(_met(finer, threshold, None).drop("many"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, line_no, row, line) for ``wanted`` (doc_id, row, at array of (line_no, h1, h2))."""
    def run(batches):
        for batch in batches:
            doc, row, out = [], [], {"h1": [], "h2": [], "line_no": [], "line": []}
            for d, r, text, at in zip(*(c.to_pylist() for c in batch.columns)):
                lines = lines_of(text)
                for x in at:
                    doc.append(d)
                    row.append(r)
                    for name in ("h1", "h2", "line_no"):
                        out[name].append(x[name])
                    out["line"].append(lines[x["line_no"]].strip(BLANKS))
            yield pa.RecordBatch.from_arrays([pa.array(out["h1"], pa.int64()), pa.array(out["h2"], pa.int64()), pa.array(doc, pa.int64()),
                                              pa.array(out["line_no"], pa.int32()), pa.array(row, pa.int64()), pa.array(out["line"], pa.string())],
                                             ["h1", "h2", "doc_id", "line_no", "row", "line"])

    places = wanted.agg(F.sum(F.size("at"))).first()[0] or 0
    return (docs.join(if_few(wanted, places), ["doc_id", "row"]).select("doc_id", "row", "text", "at")
            .mapInArrow(run, "h1 long, h2 long, doc_id long, line_no int, row long, line string").dropDuplicates(["h1", "h2"]))


def _later(entries: DataFrame, threshold: int) -> DataFrame:
    """(doc_id, line_no, row) of lines that are near an earlier one under a key.  Lines come
    in order of place; each is compared with earlier ones, those of nearest parities first,
    and no further once one is found."""
    def found(group, done):
        place, sketch, probe, line = group
        sketch, probe = np.array(sketch, np.int32).view(np.uint32), np.array(probe)
        for i in range(1, len(line)):
            if place[i] in done:
                continue
            apart = np.bitwise_count(sketch[:i] ^ sketch[i])
            near = np.flatnonzero((probe[:i] != probe[i]) & (apart <= 2 * threshold))
            for j in near[np.argsort(apart[near], kind="stable")]:
                if place[j] != place[i] and within(line[i], line[j], threshold):
                    done.add(place[i])
                    yield place[i]
                    break

    def table(places):
        doc, no, row = zip(*places) if places else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(row, pa.int64())],
                                          ["doc_id", "line_no", "row"])

    def run(batches):
        key, group, done = None, ([], [], [], []), set()
        for batch in batches:
            out = []
            for k, doc, no, row, sketch, probe, line in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    out += found(group, done)
                    key, group = k, ([], [], [], [])
                    if len(done) > 1_000_000:
                        done.clear()
                for held, x in zip(group, ((doc, no, row), sketch, probe, line)):
                    held.append(x)
            yield table(out)
        yield table(list(found(group, done)))

    names = ["key", "doc_id", "line_no", "row", "sketch", "probe", "line"]
    return (entries.select(*names).repartition("key").sortWithinPartitions("key", "doc_id", "line_no", "row", "probe")
            .mapInArrow(run, "doc_id long, line_no int, row long"))


def row_key(text_col: str = "text"):
    """What tells rows of one id apart: a hash of the text."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _prepared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       row_key(text_col).alias("row")).where("doc_id is not null")


def duplicate_lines(docs: DataFrame, threshold: int = 2, least: int = 20,
                    id_col: str = "doc_id", text_col: str = "text", least_equal: int | None = None) -> DataFrame:
    """(doc_id, row, dropped array<int>): for every document that repeats a line, the
    numbers (from 0) of its lines that equal, or are within ``threshold`` edits of, a
    line that comes earlier in the order of (doc_id, line number, row).

    Lines end at ``\\n`` and are compared without blanks at their ends; edits are allowed in
    lines of at least ``least`` (> threshold) characters, and equal lines count from
    ``least_equal`` characters (as many, unless given; 1 at least).  Null and empty texts
    have no such line; lines and texts of any length are compared whole.  Of equal lines
    the first stays, so ties can't arise but between wholly equal rows, which lose the
    same lines.  Rows without an id keep all lines and are compared with none.  ``row``
    (``row_key``) tells rows apart that share an id.  An empty table gives an empty one;
    other columns are not read."""
    if least <= threshold:
        raise ValueError("lines must be longer than the threshold")
    if not 0 <= threshold <= 15:
        raise ValueError("at most 15 edits")
    docs = _prepared(docs, id_col, text_col)
    place = ["doc_id", "line_no", "row"]
    lines = stored(_occurrences(docs, max(1, least if least_equal is None else min(least, least_equal))), "lines")
    reps = stored(lines.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("at"), F.count(F.lit(1)).alias("n")), "line-reps")
    near = stored(_candidates(docs, threshold, least), "line-near")
    wanted = (near.select("h1").distinct().join(reps, "h1")
              .groupBy("at.doc_id", "at.row").agg(F.collect_list(F.struct("at.line_no", "h1", "h2")).alias("at")))
    texts = stored(_texts(docs, stored(wanted, "line-wanted")), "line-texts")
    later = stored(_later(near.join(texts, "h1"), threshold).distinct(), "line-later")
    repeated = (lines.join(stored(reps.where("n > 1"), "line-repeated"), ["h1", "h2"])
                .where(F.struct(*place) != F.col("at")).select(*place))
    return (repeated.union(later)
            .groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("line_no")).alias("dropped")))


def without_lines(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  keep_emptied: bool = True) -> DataFrame:
    """``docs`` with the lines of ``dropped`` (from ``duplicate_lines``) taken out of the
    texts; documents that lose nothing stay as they are.  Unless ``keep_emptied``, a
    document goes if all lines that are left are blank."""
    names = docs.columns
    id_key, key, gone = (fresh_name(names, x) for x in ("_id", "_row", "_dropped"))
    lost = dropped.select(F.col("doc_id").alias(id_key), F.col("row").alias(key), F.col("dropped").alias(gone))

    def left(text: str, numbers: list[int]) -> str | None:
        numbers = set(numbers)
        lines = [x for i, x in enumerate(text.split("\n")) if i not in numbers]
        return "\n".join(lines) if keep_emptied or any(x.strip(BLANKS) for x in lines) else None

    joined = docs.join(lost, (docs[id_col] == lost[id_key]) & (row_key(text_col) == lost[key]), "left")
    return rewritten(joined.select(*names, gone), text_col, left)
