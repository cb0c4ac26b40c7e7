"""A worker keeps one operator's memory at a time; results don't depend on it."""

from __future__ import annotations

import gc
import weakref

import public_tokenizers

from tillroll.llm import bpe_codec, cotrain, shingles, worker_memory


def test_another_owner_drops_the_memory_of_the_last(monkeypatch):
    monkeypatch.setattr(worker_memory, "_owner", None)
    monkeypatch.setattr(worker_memory, "_drop", None)
    dropped = []
    worker_memory.claim("a", lambda: dropped.append("a"))
    worker_memory.claim("a", lambda: dropped.append("never"))
    assert dropped == []
    worker_memory.claim("b", lambda: dropped.append("b"))
    worker_memory.claim("a", lambda: dropped.append("a again"))
    assert dropped == ["a", "b"]


def test_coders_and_word_hashes_take_turns():
    path, text = public_tokenizers.path("word_bpe_49k.json"), "some words, é and more words"
    ids = bpe_codec.coder(path).ids(text)
    assert bpe_codec._CODERS and bpe_codec.coder(path).known_ids
    hashes = shingles.word_hashes(text)
    assert not bpe_codec._CODERS and shingles._WORDS
    assert bpe_codec.coder(path).ids(text) == ids and not shingles._WORDS
    assert (shingles.word_hashes(text) == hashes).all()


def test_a_coder_is_freed_when_another_operator_begins():
    class Sign:
        pass

    gc.collect()
    gc.disable()  # as between the collections of a busy task
    try:
        bpe_codec.coder(public_tokenizers.path("word_bpe_49k.json")).sign = sign = Sign()
        alive = weakref.ref(sign)
        del sign
        shingles.word_hashes_of(["a few words"])
        assert alive() is None
    finally:
        gc.enable()


def test_operators_without_a_memory_end_the_last_one():
    path = public_tokenizers.path("word_bpe_49k.json")
    bpe_codec.coder(path)
    cotrain.content_features("some words", {})
    assert not bpe_codec._CODERS
