"""Fuzzy search for short licence notices in whole texts.

A text is taken as its words (``words``), joined by single blanks, so that case, line
breaks and punctuation don't count as edits.  A notice that may differ by ``errors``
edits is cut into errors + 1 pieces: wherever it stands with so few edits, one piece
stands unchanged, moved by ``errors`` places at most.  One automaton finds the pieces of
all notices; at every word start that a piece allows, the regex library's bounded-error
matching verifies the notice and counts its edits.  Nothing is shuffled: a text is
scanned in the task that read it."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.line_dedup import partition

#: Bytes of words stay (A-Z as small letters), all others become blanks.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Notice:
    text: str    # words joined by single blanks, in small letters
    label: str
    errors: int  # edits (code points inserted, deleted or replaced) allowed


#: The phrases that count as base places, where they stand without an edit.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

NOTICES = (
    Notice("gnu general public license", "gpl", 3),
    Notice("apache license", "apache", 1),
    Notice("cc by", "cc-by", 0),
    Notice("mit license", "mit", 0),
    Notice("mit licence", "mit", 0),
    Notice("under the mit license", "mit", 2),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    Notice("licensed under cc by", "cc-by", 2),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("cc by nc", "cc-by-nc", 0),
    Notice("licensed under cc by nc", "cc-by-nc", 1),
    Notice("cc by sa", "cc-by-sa", 0),
    Notice("licensed under cc by sa", "cc-by-sa", 1),
    Notice("creative commons zero", "cc0", 2),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("mozilla public license", "mpl", 2),
    Notice("eclipse public license", "epl", 2),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
)

HIT = "notice string, label string, edits int, first_word int, end_word int, start int, end int"


class Searcher:
    """Finds notices in one text; built once per task."""

    def __init__(self, notices: Iterable[Notice]):
        self.notices = list(notices)
        seeds: dict[str, list] = {}
        for k, n in enumerate(self.notices):
            if not n.text or n.text != " ".join(n.text.encode().translate(_WORDS).decode().split()):
                raise ValueError(f"not words in small letters, joined by single blanks: {n.text!r}")
            if not 0 <= n.errors < len(n.text):
                raise ValueError(f"{n.text!r} needs a character more than it may lose")
            for a, b in partition(len(n.text), n.errors + 1):
                seeds.setdefault(n.text[a:b], []).append((k, a))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        if seeds:
            self.seeds.make_automaton()
        # at one place, the span of fewest edits that ends where a word ends
        self.patterns = [regex.compile(f"(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.errors}}}(?= )", regex.BESTMATCH)
                         for n in self.notices]

    def _starts(self, line: str) -> set[tuple[int, int]]:
        """(notice, place): the word starts at which an unchanged piece lets a notice begin."""
        found = set()
        for last, (size, places) in self.seeds.iter(line):
            for k, offset in places:
                about, errors = last + 1 - size - offset, self.notices[k].errors
                at = line.find(" ", max(about - errors - 1, 0))
                while 0 <= at < about + errors and at < len(line) - 1:
                    found.add((k, at + 1))
                    at = line.find(" ", at + 1)
        return found

    def hits(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of the blank-framed words ``line``.  Of spans of one
        notice that overlap, the one of fewest edits stays, and of those the first."""
        if len(line) < 3 or not self.notices:
            return []
        spans = []
        for k, at in self._starts(line):
            m = self.patterns[k].match(line, at)
            if m:
                spans.append((k, sum(m.fuzzy_counts), at, m.end()))
        best: dict[int, list] = {}
        for k, edits, a, b in sorted(spans):
            best.setdefault(k, []).append((edits, a, b))
        return sorted((k, a, b, edits) for k, found in best.items() for edits, a, b in _apart(found))


def _apart(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end) in order, those that overlap none taken before them."""
    if len(found) < 2:
        return found
    starts: list[int] = []
    ends: list[int] = []
    taken = []
    for edits, a, b in found:
        at = bisect_left(starts, b)
        if at and ends[at - 1] > a:
            continue
        starts.insert(at, a)
        ends.insert(at, b)
        taken.append((edits, a, b))
    return taken


def framed(text: str | None) -> tuple[int, str]:
    """Number of words, and the words with one blank before, between and after them."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return len(words), f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "


def scan(docs: DataFrame, notices: Iterable[Notice] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, hits) for every row of ``docs``.  A hit is a notice with its label,
    its edits, its words [first_word, end_word) and its place [start, end) in the text, in
    code points; hits come in the order of the notices, then of place.

    Lower-cases A-Z and takes words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  Null and empty
    texts have no words and no hits.  Every row gives one row: repeated rows and null ids
    too.  Spans of different notices may overlap; of spans of one notice that do, the one of
    fewest edits counts, the first of equals.  Only id and text are read; an empty table
    gives an empty one.  Texts of any length are searched whole."""
    notices = tuple(notices)
    Searcher(notices)  # faults show on the driver
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("hits", T.ArrayType(T._parse_datatype_string(HIT)))])
    hit_type = pa.list_(pa.struct([("notice", pa.string()), ("label", pa.string()), ("edits", pa.int32()),
                                   ("first_word", pa.int32()), ("end_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        searcher = Searcher(notices)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                counts, hits = [], []
                for text in b.column(1).to_pylist():
                    n, line = framed(text)
                    counts.append(n)
                    found, rows = searcher.hits(line), []
                    if found:
                        places = [m.span() for m in _WORD.finditer(text)]
                        # a span starts where a word starts and ends where one ends
                        starts = {p + 1: i for i, p in enumerate(m.start() for m in re.finditer(" ", line))}
                        for k, a, e, edits in found:
                            first, end = starts[a], starts[e + 1] if e + 1 in starts else n
                            rows.append({"notice": notices[k].text, "label": notices[k].label, "edits": edits, "first_word": first,
                                         "end_word": end, "start": places[first][0], "end": places[end - 1][1]})
                    hits.append(rows)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(hits, hit_type)],
                                                 ["doc_id", "n_words", "hits"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def summary(scanned: DataFrame, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for the
    rows of ``scan``.  Base places are the hits of ``base`` phrases without an edit; the
    score is that of the closest hit: 1 less the share of its notice's code points that are
    edited (0 without a hit)."""
    phrase = F.create_map(*[F.lit(x) for pair in base for x in pair])
    places = F.filter("hits", lambda h: (h["edits"] == 0) & F.array_contains(F.map_keys(phrase), h["notice"]))
    joined = lambda a, get: F.array_join(F.array_sort(F.array_distinct(F.transform(a, get))), ",")
    word = F.transform("places", lambda h: h["first_word"].cast("long"))
    score = F.array_max(F.transform("hits", lambda h: 1 - h["edits"] / F.length(h["notice"])))
    return scanned.withColumn("places", places).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"), F.array_max(word).alias("last_word"),
        joined("places", lambda h: h["label"]).alias("base_labels"), joined("hits", lambda h: h["label"]).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"))
