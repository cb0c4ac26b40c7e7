"""BPE encoding and decoding by forced boundaries.

Inside a pre-token the merge rules can only ever join two neighbouring bytes if
that byte pair stands somewhere inside a vocabulary token.  A pair that stands in
no token is a certain cut: no merge crosses it, so the fragments on both sides
are encoded independently and their ids concatenated.  White space and the
special strings are cuts in the same sense.  Fragments repeat a lot, so each
task keeps the ids of those it has seen.

The text → pre-token rules (normalizer, splitting) are taken from the tokenizer
file itself through the ``tokenizers`` library; merges are run per fragment."""

from __future__ import annotations

import hashlib
import operator
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa

from tillroll.llm.worker_memory import claim

#: White space of the tokenizer's own splitting rule (the Unicode property).
_SPLIT = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: The same splitting rule within Latin-1, where normalization changes nothing:
#: contractions, runs of letters, single number signs, runs of the rest.
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r \x85\xa0{_LETTER}{_NUMBER}]+")
_FIRST = operator.itemgetter(0)
#: Entries kept per worker (with the decoded text, or ids alone); beyond it the memory
#: starts anew, which changes no result.
CACHE_ENTRIES, CACHE_IDS = 400_000, 500_000


def _byte_alphabet() -> dict[int, str]:
    """Byte → letter of byte-level tokenizers: printable ones stand for themselves,
    the rest are numbered on from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


class FragmentCoder:
    """Encoder of one tokenizer file: ``chunk(text without space) -> (ids as
    little-endian 32-bit bytes, decoded text in UTF-8)``."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        # two models over the same merges: the last fragment of a pre-token carries
        # the word-end mark, the others don't
        self.last = BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix or None, cache_capacity=0)
        self.inner = BPE(vocab=vocab, merges=merges, cache_capacity=0)
        self.joined = set()
        for token in vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.joined.update(zip(body, body[1:]))
        self.pieces = _Pieces(self)
        self.known, self.known_ids = _Known(self.piece, CACHE_ENTRIES), _Known(self.piece_ids, CACHE_IDS)
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}

    def fragments(self, piece: str) -> list[str]:
        """A pre-token (in the tokenizer's byte alphabet) cut at every pair of
        bytes that stands in no vocabulary token."""
        joined, out, start = self.joined, [], 0
        for k in range(1, len(piece)):
            if (piece[k - 1], piece[k]) not in joined:
                out.append(piece[start:k])
                start = k
        out.append(piece[start:])
        return out

    def tokens(self, word: str) -> list:
        """Tokens of a pre-token in the tokenizer's byte alphabet, fragment by fragment."""
        *first, last = self.fragments(word)
        out = []
        for fragment in first:
            out += self.inner.tokenize(fragment)
        return out + self.last.tokenize(last)

    def piece(self, word: str) -> tuple[bytes, bytes]:
        """Ids (little-endian 32 bit) and decoded text (UTF-8) of a pre-token."""
        tokens = self.tokens(word)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]), " ".join([t.value for t in tokens]).encode()

    def piece_ids(self, word: str) -> bytes:
        tokens = self.tokens(word)
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def any_chunk(self, chunk: str) -> list[tuple[bytes, bytes]]:
        """Codes of a text, by the library's own normalizer and splitting."""
        out = []
        pieces = self.special_cut.split(chunk) if self.special_cut else [chunk]
        for k, part in enumerate(pieces):
            if k % 2:
                out.append((self.special[part].to_bytes(4, "little"), part.encode()))
            elif part:
                clean = self.tokenizer.normalizer.normalize_str(part)
                out += [self.pieces[word] for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(clean)]
        return out

    def codes(self, text: str, known: dict, take) -> list:
        """Codes of all pre-tokens of a text, in order; ``take`` picks what
        ``known`` keeps of a code."""
        known = known.__getitem__
        if "<|" not in text:
            try:
                text.encode("latin-1")
                return list(map(known, _PIECES.findall(text.lower())))
            except UnicodeEncodeError:
                pass
        out = []
        for chunk in _SPLIT.split(text):
            if chunk:
                if "<|" in chunk or not chunk.isascii():
                    out += map(take, self.any_chunk(chunk))
                else:
                    out += map(known, _PIECES.findall(chunk.lower()))
        return out

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids (little-endian 32 bit) and decoded text (UTF-8) of a whole text."""
        got = self.codes(text or "", self.known, tuple)
        return b"".join([x[0] for x in got]), b" ".join([x[1] for x in got])

    def ids(self, text: str | None) -> bytes:
        return b"".join(self.codes(text or "", self.known_ids, _FIRST))

    def decode(self, ids) -> str:
        """The library's decode() with special tokens kept: this tokenizer file
        names no decoder, so tokens are joined by one space."""
        return " ".join(self.names[int(i)] for i in ids)


class _Pieces(dict):
    """Codes of pre-tokens in the byte alphabet (texts beyond Latin-1)."""

    def __init__(self, coder: FragmentCoder):
        super().__init__()
        self.coder = coder

    def __missing__(self, word: str) -> tuple[bytes, bytes]:
        got = self.coder.piece(word)
        if len(word) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = got
        return got


class _Known(dict):
    """Codes of the lower-case Latin-1 pre-tokens that this worker has seen."""

    def __init__(self, encode, entries: int):
        super().__init__()
        self.encode, self.entries = encode, entries

    def __missing__(self, word: str):
        got = self.encode(word.encode().decode("latin-1").translate(_ALPHABET))
        if len(word) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[word] = got
        return got


_CODERS: dict[str, FragmentCoder] = {}


def coder(path: str) -> FragmentCoder:
    """One coder per worker process and file; workers are reused between tasks."""
    claim("bpe", _CODERS.clear)
    if path not in _CODERS:
        _CODERS[path] = FragmentCoder(path)
    return _CODERS[path]


def encode_documents(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """(doc_id, ids binary, decoded string) of every document, whole texts.

    Null and empty texts give no ids and an empty decoded text; other columns of
    ``docs`` are not read.  Row-wise, no shuffle; ``path`` is the tokenizer file,
    present on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                out = [c.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x[0] for x in out], pa.binary()),
                     pa.array([x[1].decode() for x in out], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids binary, decoded string")


def digest_documents(docs, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """As ``encode_documents``, but (doc_id, n_tokens, ids_sha256, decoded_sha256):
    ids and decoded texts are hashed where they are made and never leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for b in batches:
            n, a, d = [], [], []
            texts = b.column(1)
            for k in range(b.num_rows):
                ids, decoded = c.encode(texts[k].as_py())
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                d.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_pieces(docs, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 keep_ids: bool = False):
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's ids followed
    by ``end_id``, cut into pieces of ``capacity`` ids (the last may be shorter).  A
    null or empty text is ``end_id`` alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, end, step = coder(path), end_id.to_bytes(4, "little"), 4 * capacity
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())[:5 + keep_ids]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + keep_ids]
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                b, rows = batch.slice(begin, 512), []
                texts = b.column(1)
                for k, doc in enumerate(b.column(0).to_pylist()):
                    ids = c.ids(texts[k].as_py()) + end
                    rows += [(doc, p, at // 4, len(part := ids[at:at + step]) // 4, zlib.crc32(part), part)
                             for p, at in enumerate(range(0, len(ids), step))]
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)], names)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"
                    + (", ids binary" if keep_ids else ""))
