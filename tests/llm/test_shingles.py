"""Hashes of many texts' words at once against the hashing library, word by word."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from tillroll.llm import shingles as m


def _texts():
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abXYZ01é漢😀\x00\x1c.,") for _ in range(rnd.randint(0, 24)))
    return [None, "", "  ", "a", " ab", "abc ", *(rnd.choice([" ", "\n", "\t\x0b", "\x0c\r"]).join(word() for _ in range(rnd.randint(0, 60)))
                                                  for _ in range(300)), "\n"]


def test_words_of_many_texts_hash_as_one_by_one():
    texts = _texts()
    got = m.word_hashes_of(texts)
    assert len(got) == len(texts)
    for text, hashes in zip(texts, got):
        assert hashes.tolist() == [xxhash.xxh3_64_intdigest(w) for w in m.words(text)]
    assert m.word_hashes_of([]) == [] and [len(x) for x in m.word_hashes_of([None, ""])] == [0, 0]


def test_shingle_sets_of_many_texts():
    texts = _texts()
    for k in (1, 2, 5):
        assert all(np.array_equal(a, m.shingle_set(t, k)) for a, t in zip(m.shingle_sets_of(texts, k), texts))


def test_words_of_many_texts_are_not_kept():
    m._WORDS.clear()
    m.word_hashes_of([f"word{k}" for k in range(1000)])
    assert not m._WORDS
