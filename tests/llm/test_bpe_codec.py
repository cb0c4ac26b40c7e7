"""Forced-boundary coder against the tokenizers library, text by text."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm.bpe_codec import FragmentCoder, digest_documents, encode_documents, token_pieces
from tillroll.llm.store import table

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", " ", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "é ́x", "ΑΣ Σ.", "a\x1cb\x1f c",
        "it's we'll 12３４", " x y z", "\u0000 \U0001F600", "İstanbul ǅ ﬁ",
        "日本語、と。", "a​b﻿", "x" * 5000, "...!!!***'s't", "< |endoftext|>", "\x85a᠎b",
        "\xaa\xba\xb5\xb2\xbc\xd7\xf7", "word " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode()


def test_same_ids_and_text_as_the_library(library):
    rnd = random.Random(5)
    letters = "abÉéßçüö'’sS .,!#*|<>\n\t1２0日本한̧́̀  😀‍İıſ\x1c\x85"
    texts = HARD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 90))) for _ in range(2000)]
    c = FragmentCoder(PATH)
    for t in texts:
        assert c.encode(t) == _expected(library, t), repr(t[:80])
        assert c.ids(t) == _expected(library, t)[0]


def test_cuts_are_never_inside_a_token():
    c = FragmentCoder(PATH)
    assert all(len(c.fragments(t.removesuffix("</w>"))) == 1 for t in list(c.names.values())[:49000:7])
    assert len(c.fragments("a!b")) >= 2 and "".join(c.fragments("qzxj!é")) == "qzxj!é"


def test_small_memory_changes_nothing(library, monkeypatch):
    import tillroll.llm.bpe_codec as m
    monkeypatch.setattr(m, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(m, "CACHE_IDS", 3)
    c = FragmentCoder(PATH)
    text = "some words come again and again as some words do, été à la carte " * 20
    assert c.encode(text) == _expected(library, text) and c.ids(text) == _expected(library, text)[0]


def test_documents_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "Hello world", 5, "x"), (1, "Hello world", 5, "x"), (None, "a b", None, None), (3, None, 1, "y"),
            (4, "", 1, "y"), (5, "é" * 40000, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    got = sorted(map(tuple, digest_documents(docs, PATH).collect()), key=str)
    want = [(r[0], len(e[0]) // 4, hashlib.sha256(e[0]).hexdigest(), hashlib.sha256(e[1]).hexdigest())
            for r in rows for e in [_expected(library, r[1])]]
    assert got == sorted(want, key=str)
    assert encode_documents(docs.limit(0), PATH).count() == 0
    assert [r["decoded"] for r in encode_documents(docs.where("doc_id = 3"), PATH).collect()] == [""]


def test_whole_table(spark, sf, library):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in digest_documents(docs, PATH).collect():
        ids, decoded = _expected(library, texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == \
            (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())


def test_pieces_cut_only_long_documents(spark):
    docs = spark.createDataFrame([(1, "a " * 25), (2, None), (3, "a " * 9)], "doc_id long, text string")
    got = [(r["doc_id"], r["piece"], r["start"], r["length"]) for r in
           token_pieces(docs, PATH, 10).orderBy("doc_id", "piece").collect()]
    assert got == [(1, 0, 0, 10), (1, 1, 10, 10), (1, 2, 20, 6), (2, 0, 0, 1), (3, 0, 0, 10)]
