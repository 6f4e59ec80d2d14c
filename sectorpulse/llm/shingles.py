"""Word shingles of whole texts as 64-bit hashes, computed on byte arrays.

Words are runs of bytes other than white space (space, U+0009 to U+000D),
A-Z lower-cased. A word's hash is a polynomial over its bytes, read off a
running sum, so a chunk of many texts is hashed by a few array operations.
Five neighbouring word hashes make a shingle; a text of one to four words has
its whole sequence as its only shingle. Equal words give equal hashes; two
different shingles of one comparison collide with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SHINGLE_WORDS = 5
CHUNK_BYTES = 1 << 20                 # texts are hashed in chunks of about this size
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits (a finaliser of public-domain hashes)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, as long as the longest chunk so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.inverse = _U(pow(int(_BASE), -1, 2 ** 64))

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES)
            for name, base in (("up", _BASE), ("down", self.inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_POWERS = _Powers()


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset, hash) of every word."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _POWERS.upto(len(raw) + 1)
    low = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + _U(1)) * up[:len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _combine(words: np.ndarray, count: int) -> np.ndarray:
    """Hash of ``count`` neighbouring words, for every first word."""
    n = len(words) - count + 1
    out = np.full(n, count, dtype=np.uint64)
    for k in range(count):
        out = out * _BASE + words[k:k + n]
    return mix(out)


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, in order."""
    chunk: list[bytes] = []
    size = 0
    for text in texts:
        chunk.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(chunk[-1]) + 1
        if size >= CHUNK_BYTES:
            yield from _chunk_sets(chunk)
            chunk, size = [], 0
    yield from _chunk_sets(chunk)


def _chunk_sets(chunk: list[bytes]) -> Iterator[np.ndarray]:
    if not chunk:
        return
    starts, words = word_hashes(b"\n".join(chunk))
    ends = np.cumsum([len(x) + 1 for x in chunk])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    fives = _combine(words, SHINGLE_WORDS) if len(words) >= SHINGLE_WORDS else None
    for first, last in zip(bounds[:-1], bounds[1:]):
        n = last - first
        if n >= SHINGLE_WORDS:
            yield np.unique(fives[first:last - SHINGLE_WORDS + 1])
        elif n:
            yield _combine(words[first:last], n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union (sorted distinct arrays; empty sets match nothing)."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)
