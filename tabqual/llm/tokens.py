"""Vectorised hashing of words and byte n-grams, run by numpy inside Spark tasks.

Texts are handled as UTF-8 bytes in chunks of whole documents. A word's hash is
a polynomial over its bytes taken from one running sum per chunk, so no Python
loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)

#: Bytes of a word: ASCII letters and digits, and every byte of a non-ASCII character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
WORD_BYTE[128:] = True

_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        n = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def chunks(texts, chunk_bytes: int = CHUNK_BYTES, lower: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, bytes, document starts)``; NULL counts as the empty text.

    ``starts`` has one entry more than the chunk has documents; a line feed ends each document.
    """
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = ((t.lower() if lower else t).encode("utf-8", "surrogatepass") if isinstance(t, str) else b"") + b"\n"
        if held and size + len(b) > chunk_bytes:
            yield first, np.frombuffer(b"".join(held), np.uint8), _starts(held)
            first, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield first, np.frombuffer(b"".join(held), np.uint8), _starts(held)


def _starts(parts: list[bytes]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))


def words(buf: np.ndarray, starts: np.ndarray, word_byte: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the chunk, and the index of each document's first word (one entry more)."""
    inside = word_byte[buf].view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * up[: len(buf)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin]), np.searchsorted(begin, starts)


def shingles(word_hash: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words within a document, and each document's first shingle (one entry more).

    A document of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    doc = np.repeat(np.arange(len(n_words)), counts)
    at = first[doc] + (np.arange(offsets[-1]) - offsets[doc])
    last = first[doc + 1]
    padded = np.concatenate((word_hash, np.zeros(k, np.uint64)))
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        w = padded[at + j]
        out = mix(out * _BASE + np.where(at + j < last, w, np.uint64(0)))
    return out, offsets


def byte_ngrams(buf: np.ndarray, sizes, bits: int) -> list[np.ndarray]:
    """For each size n, the hash (``bits`` wide) of the n bytes that start at every position."""
    padded = np.concatenate((buf, np.zeros(max(sizes), np.uint8))).astype(np.uint32)
    out, code = [], np.zeros(len(buf), np.uint32)
    for n in range(1, max(sizes) + 1):
        code = (code + padded[n - 1: n - 1 + len(buf)] + np.uint32(1)) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        if n in sizes:
            out.append(((code * np.uint32(0x85EBCA77) + np.uint32(n)) >> np.uint32(32 - bits)).astype(np.int64))
    return out
