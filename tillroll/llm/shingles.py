"""Hashed word shingles of whole texts, for tasks that get Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

from tillroll.llm.worker_memory import claim

#: ASCII capitals to small letters, byte by byte (UTF-8 continuation bytes stay).
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CACHE_ENTRIES = 400_000
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_M4, _LOW = np.uint64(0x9FB21C651E98DF25), np.uint64(0xFFFFFFFF)
_S33, _S32, _S29 = np.uint64(33), np.uint64(32), np.uint64(29)


class _Words(dict):
    """word → 64-bit hash, for the words this worker has seen lately."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = h
        return h


_WORDS = _Words()


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def word_hashes(text: str | None) -> np.ndarray:
    claim("words", _WORDS.clear)
    w = words(text)
    return np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))


def _bits(h: np.ndarray, *shifts: int) -> np.ndarray:
    """``h`` with its own bits, rotated left by each of ``shifts``, over it."""
    out = h.copy()
    for x in shifts:
        out ^= (h << np.uint64(x)) | (h >> np.uint64(64 - x))
    return out


def _folded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper and lower half of the 128-bit products, one over the other."""
    a0, a1, b0, b1 = a & _LOW, a >> _S32, b & _LOW, b >> _S32
    low, mid, other = a0 * b0, a1 * b0, a0 * b1
    carry = (low >> _S32) + (mid & _LOW) + other
    return (a1 * b1 + (mid >> _S32) + (carry >> _S32)) ^ ((carry << _S32) | (low & _LOW))


def word_hashes_of(texts: list[str | None]) -> list[np.ndarray]:
    """``word_hashes`` of each of several texts: XXH3 of all words at once, without a
    memory of words seen."""
    claim("batch")
    raw = [(x or "").encode("utf-8", "surrogatepass") for x in texts]
    ends = np.cumsum([len(x) + 1 for x in raw])
    joined = b" ".join([b"       ", *raw, b"        "]).translate(_LOWER)  # blanks on both sides, so reads of 8 bytes fit
    flat = np.frombuffer(joined, np.uint8)
    blank = (flat == 32) | (flat - np.uint8(9) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    at, end = edges[::2], edges[1::2]
    n = end - at
    eight, four = (np.ndarray(len(joined) - int(k[-1]) + 1, k, joined, strides=(1,)) for k in ("<u8", "<u4"))
    out = np.empty(len(n), np.uint64)
    i = np.flatnonzero(n <= 3)
    if len(i):
        a, m = at[i], n[i]
        h = flat[a].astype(np.uint64) << np.uint64(16) | flat[a + (m >> 1)].astype(np.uint64) << np.uint64(24) \
            | flat[a + m - 1] | m.astype(np.uint64) << np.uint64(8)
        h ^= np.uint64(0x87275A9B)
        h = (h ^ (h >> _S33)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> _S29)) * np.uint64(0x165667B19E3779F9)
        out[i] = h ^ (h >> _S32)
    i = np.flatnonzero((n > 3) & (n <= 8))
    if len(i):
        h = (four[end[i] - 4].astype(np.uint64) + (four[at[i]].astype(np.uint64) << _S32)) ^ np.uint64(0xC73AB174C5ECD5A2)
        h = _bits(h, 49, 24) * _M4
        h = (h ^ ((h >> np.uint64(35)) + n[i].astype(np.uint64))) * _M4
        out[i] = h ^ (h >> np.uint64(28))
    i = np.flatnonzero((n > 8) & (n <= 16))
    if len(i):
        a, b = eight[at[i]] ^ np.uint64(0x6782737BEA4239B9), eight[end[i] - 8] ^ np.uint64(0xAF56BC3B0996523A)
        h = n[i].astype(np.uint64) + a.byteswap() + b + _folded(a, b)
        h = (h ^ (h >> np.uint64(37))) * np.uint64(0x165667919E3779F9)
        out[i] = h ^ (h >> _S32)
    i = np.flatnonzero(n > 16)
    out[i] = np.fromiter((xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(at[i].tolist(), end[i].tolist())), np.uint64, len(i))
    return np.split(out, np.searchsorted(at, ends[:-1] + 8)) if len(texts) else []


def mix(h: np.ndarray) -> np.ndarray:
    """A full-avalanche mixer of 64-bit values."""
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S29)) * _M2
    return h ^ (h >> _S32)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, in order of place (empty if there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = hashes[:n] + np.uint64((k * int(_M3)) % 2**64)
    for j in range(1, k):
        h = mix(h) * _M3 + hashes[j:j + n]
    return mix(h)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer than ``k`` words is one
    shingle, one without words none."""
    return _shingles(word_hashes(text), k)


def shingle_sets_of(texts: list[str | None], k: int) -> list[np.ndarray]:
    """``shingle_set`` of each of several texts."""
    return [_shingles(h, k) for h in word_hashes_of(texts)]


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    return np.unique(windows(h, min(k, len(h)))) if len(h) else h
