"""Spelling variants by search schemes over an FM-index, forwards and backwards.

Two words one edit apart agree in one half: if the longer side of the pair has ``l`` code
points, in its first ``l // 2`` or in the rest.  Words are dealt to blocks by length and
half, so that those that may be near meet.  A block of second halves is indexed as its
delimited words, one of first halves as its words read backwards; a search begins at the
delimiter, matches the half exactly and extends its suffix-rank interval over the other
half with one inserted, deleted or replaced code point, up to the delimiter on that side.
All searches of a block move on together, one code point a step."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import if_few, ship, stored

#: Words of an index, and the searches that move on together.
BLOCK = 1 << 15
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_UPPER_CASE, _LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD_WORDS = 200_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the sorted suffixes of ``text`` (numbers from 0), by prefix doubling."""
    n, k = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.r_[0, np.diff(key[order]) > 0])
        if new[order[-1]] == n - 1:
            return order
        rank, k = new, 2 * k
        if k >= n:
            return np.argsort(rank, kind="stable")


def _codes(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Index:
    """An FM-index of distinct words, each followed by a delimiter (symbol 0)."""

    def __init__(self, words: list[str]):
        lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        self.alphabet, symbols = np.unique(_codes(words), return_inverse=True)
        text[inside] = symbols + 1
        order = suffix_array(text)
        self.bwt = text[order - 1]      # the first word is preceded by the last delimiter
        self.n = len(text)
        places = np.argsort(self.bwt, kind="stable")
        self.keys = self.bwt[places] * (self.n + 1) + places
        # the k-th delimiter of the transform stands before this word
        self.word = np.searchsorted(ends, order[places[:len(words)]])
        self.words = len(words)

    def symbols(self, words: list[str]) -> np.ndarray:
        """Symbols of the words' code points, one after another; -1: not in the index."""
        codes = _codes(words)
        if not len(self.alphabet):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, -1)

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The rank of ``symbol`` + the suffix of each row: an interval's ends, one symbol to the left."""
        return np.searchsorted(self.keys, symbol * (self.n + 1) + row)

    def _branch(self, low, high, other):
        """(which interval, low, high): each interval extended by every symbol but the delimiter and ``other``."""
        size = high - low
        n_symbols = len(self.alphabet)
        few = np.flatnonzero(size <= n_symbols)
        which = np.repeat(few, size[few])
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[which]
        symbol = self.bwt[rows]
        keep = (symbol != 0) & (symbol != other[which])
        which = which[keep]
        start = self.step(symbol[keep], rows[keep])
        many = np.flatnonzero(size > n_symbols)
        if not len(many):
            return which, start, start + 1
        w = np.repeat(many, n_symbols)
        symbol = np.tile(np.arange(1, n_symbols + 1), len(many))
        keep = symbol != other[w]
        w, symbol = w[keep], symbol[keep]
        a, b = self.step(symbol, low[w]), self.step(symbol, high[w])
        keep = a < b
        return np.r_[which, w[keep]], np.r_[start, a[keep]], np.r_[start + 1, b[keep]]

    def find(self, words: list[str], length: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers: for query ``words[k]`` all indexed words of ``length[k]`` code
        points (its own, one more or one fewer) that share its last ``exact[k]`` ones and
        differ by one edit before them.  Each pair once: of equal neighbours, the edit is at
        the one furthest from the exact half."""
        symbols = self.symbols(words)
        size = np.array([len(w) for w in words], np.int64)
        last = np.cumsum(size) - 1
        kind = length - size

        def char(q, s):  # the s-th symbol from the end, -2 beyond the start
            inside = s < size[q]
            return np.where(inside, symbols[np.where(inside, last[q] - s, 0)], -2) if len(symbols) else np.full(len(q), -2)

        # intervals without an error yet, and with one
        q, low, high = np.arange(len(words)), np.zeros(len(words), np.int64), np.full(len(words), self.words, np.int64)
        xq, xlow, xhigh = (np.empty(0, np.int64) for _ in range(3))
        found_q, found_w, s = [], [], 0
        while len(q) or len(xq):
            c = char(q, s)
            more, free = c != -2, s >= exact[q]
            later = []
            put = np.flatnonzero(free & (kind[q] == 1))
            if len(put):
                w, a, b = self._branch(low[put], high[put], c[put])
                xq, xlow, xhigh = np.r_[xq, q[put[w]]], np.r_[xlow, a], np.r_[xhigh, b]
            change = np.flatnonzero(free & more & (kind[q] == 0))
            if len(change):
                w, a, b = self._branch(low[change], high[change], c[change])
                later.append((q[change[w]], a, b))
            drop = np.flatnonzero(free & more & (kind[q] == -1))
            drop = drop[char(q[drop], s + 1) != c[drop]]
            later.append((q[drop], low[drop], high[drop]))

            whole = size[xq] == s
            if whole.any():
                a, b = self.step(np.int64(0), xlow[whole]), self.step(np.int64(0), xhigh[whole])
                found_q.append(xq[whole][a < b])
                found_w.append(self.word[a[a < b]])
            xq, xlow, xhigh = self._advance(xq[~whole], xlow[~whole], xhigh[~whole], char, s)
            q, low, high = self._advance(q[more], low[more], high[more], char, s)
            xq, xlow, xhigh = (np.concatenate([x, *(y[i] for y in later)]) for i, x in enumerate((xq, xlow, xhigh)))
            s += 1
        return (np.concatenate(found_q), np.concatenate(found_w)) if found_q else (xq, xq)

    def _advance(self, q, low, high, char, s):
        c = char(q, s)
        known = c > 0
        q, c = q[known], c[known]
        low, high = self.step(c, low[known]), self.step(c, high[known])
        keep = low < high
        return q[keep], low[keep], high[keep]


def vocabulary(docs: DataFrame, least: int = 7, least_count: int = 2, change: Callable[[object, str], str] | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts, A-Z in lower case, with
    their number, if they have ``least`` code points and occur ``least_count`` times.
    ``change(doc_id)`` gives a function from a run to the word it counts as; it may only
    shorten runs.  Null and empty texts have no words; rows without an id and repeated
    rows count like any other.  Words are counted in tasks before they are shuffled."""
    ship(docs.sparkSession)

    def run(batches):
        find = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall
        held: Counter = Counter()

        def table():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    runs = find((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))
                    if change is None:
                        held.update(runs)
                    else:
                        word_of = change(d)
                        for x, n in Counter(runs).items():
                            word = word_of(x)
                            if len(word) >= least:
                                held[word] += n
                if len(held) > HELD_WORDS:
                    yield table()
        if held:
            yield table()

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _searches(words: DataFrame, block: int) -> DataFrame:
    """(place, part, asks, backwards, l, word, n): each word as an index entry and search of
    its own length in the two blocks of its halves (asks 0), and as a search in the blocks
    of words one longer or shorter (asks 1)."""
    n_blocks = max(1, -(-2 * words.count() // block))
    size, half = F.length("word"), F.floor(F.col("l") / 2).cast("int")
    rows = (words.select("word", "n", size.alias("size"), F.explode(F.array(size - 1, size, size + 1)).alias("l"))
            .select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("backwards"))
            # backwards: the first half stands at the end of the word that is read from its end
            .withColumn("half", F.when(F.col("backwards"), F.substr("word", F.lit(1), half))
                        .otherwise(F.substr("word", F.col("size") - (F.col("l") - half) + 1)))
            .select(F.pmod(F.xxhash64("backwards", "l", "half"), F.lit(n_blocks)).cast("int").alias("place"),
                    F.when(F.col("l") == F.col("size"), 0).otherwise(1).alias("asks"), "backwards", "l", "word", "n"))
    # a key that very many words share makes a large block: its words are split, its searches go to all parts
    hot = stored(rows.where("asks = 0").groupBy("place").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 4 * block)
                 .select("place", F.ceil(F.col("held") / block).cast("int").alias("parts")), "variants-hot")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    return (rows.join(if_few(hot), "place", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("asks", F.when((F.col("asks") == 0) & (F.col("part") == own), 0).otherwise(1))
            .select("place", "part", "asks", "backwards", "l", "word", "n"))


def _pairs_of_block(index: Index, entries: list[tuple[str, int]], backwards: bool, asked: list[tuple[str, int]]):
    """(word, near words found, -n and text of the most frequent) for (word, l) in ``asked``."""
    words = [w[::-1] for w, _ in asked] if backwards else [w for w, _ in asked]
    length = np.array([x for _, x in asked], np.int64)
    exact = length // 2 if backwards else length - length // 2
    best: dict[int, list] = {}
    for q, w in zip(*(x.tolist() for x in index.find(words, length, exact))):
        word, n = entries[w]
        mine, l = asked[q]
        if not backwards and mine[:l // 2] == word[:l // 2]:
            continue  # found by the first half, too, and counted there
        old = best.get(q)
        if old is None:
            best[q] = [1, (-n, word)]
        else:
            old[0] += 1
            old[1] = min(old[1], (-n, word))
    return [(asked[q][0], k, -n, form) for q, (k, (n, form)) in best.items()]


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, form_n, form) for every word of ``words`` (distinct word, n) that has
    words within one edit: their number and the most frequent (the first in code-point
    order of equals)."""
    def run(batches):
        names = ["word", "n_near", "form_n", "form"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        at, entries, index, asked, flipped, out = None, [], None, [], False, []

        def answer():
            nonlocal index, asked
            if entries and asked:
                if index is None:
                    index = Index([w[::-1] for w, _ in entries] if flipped else [w for w, _ in entries])
                out.extend(_pairs_of_block(index, entries, flipped, asked))
            asked = []

        for batch in batches:
            for place, part, asks, backwards, l, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (place, part, backwards) != at:
                    answer()
                    at, entries, index, flipped = (place, part, backwards), [], None, backwards
                if not asks:
                    entries.append((word, n))
                asked.append((word, l))
                if asks and len(asked) >= BLOCK:
                    answer()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)
                out = []
        answer()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)

    order = ["place", "part", "backwards", "asks"]
    found = (_searches(words, block).repartition("place", "part").sortWithinPartitions(*order)
             .mapInArrow(run, "word string, n_near long, form_n long, form string"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("n"), "form")).alias("best"))
            .select("word", "n_near", (-F.col("best.n")).alias("form_n"), "best.form"))


def group_variants(words: DataFrame, ratio: int = 10, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for ``words`` (distinct word, n; both not null).

    Two words are near if they differ by one inserted, deleted or replaced code point.  A
    word's form is its most frequent near word (the first in code-point order of equals), if
    that is ``ratio`` times as frequent or more, else null; its root is where its forms lead.
    Words of any characters and lengths of at least two code points are searched; an empty
    table gives an empty one.  With ``ratio`` of two or more, frequencies grow along a chain
    of forms, so it ends within 62 steps and its root is found in six joins."""
    if ratio < 2:
        raise ValueError("forms must be twice as frequent at least")
    words = stored(words.select("word", "n"), "variants-words")
    near = stored(near_words(words, block), "variants-near")
    out = words.join(near, "word", "left").withColumn("has", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
    out = stored(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("has"), F.col("form")).alias("form"),
                            F.when(F.col("has"), F.col("form_n")).alias("form_n")), "variants-forms")
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       "variants-roots")
        if not roots.where("moved").limit(1).count():
            break
        roots = roots.select("word", "root")
    return (out.join(roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def misspell(doc_id: object) -> Callable[[str], str]:
    """Runs of a document lose a code point if 31 divides the crc32 of ``<doc_id>:<run>``
    (a null id is an empty one): the number modulo the run's length says which."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def word(run: str) -> str:
        h = zlib.crc32(run.encode(), begun)
        if h % 31:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]

    return word


def misspelled_groups(docs: DataFrame) -> DataFrame:
    """The groups of all words of ``docs`` of seven code points that occur twice."""
    return group_variants(vocabulary(docs, 7, 2, misspell))


def misspelled_groups_sql(documents: str = "documents") -> str:
    """The same groups as one DuckDB statement: near words share what is left when one code
    point is taken from either or from the longer one."""
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) AS v
    FROM range(256) t(i))),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER_CASE}', '{_LOWER_CASE}') AS run FROM {documents}),
counted AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT run, k, flatten(list_transform(string_split(concat(id, ':', run), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM counted),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295, b), lambda s, x: xor(s >> 8, crc[(xor(s, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc_table),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM words, range(length(word)) r(i)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON c.cut = w.word
  UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON c.cut = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, coalesce(form, word) AS root FROM forms
  UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""
