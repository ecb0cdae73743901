"""Hashed word shingles of texts, computed over whole buffers.

Words are what stands between ASCII white space, A-Z in lower case. A word's
hash is a polynomial over its bytes (prefix sums, so one pass serves all words
of a buffer), a shingle's hash mixes the hashes of its words in order; 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
BUFFER = 1 << 19  # bytes hashed at once

_u = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_PLACES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_LENGTH = _u(0x8EBC6AF09C88C6E3)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def encoded(column, rows: int = 256) -> Iterator[bytes]:
    """The texts of an Arrow column in UTF-8 (null: empty), a few rows at a time, so
    that a batch of long texts is not held a second and third time."""
    for i in range(0, len(column), rows):
        for t in column.slice(i, rows).to_pylist():
            yield (t or "").encode("utf-8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u(30))) * _u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _u(27))) * _u(0x94D049BB133111EB)
    return x ^ (x >> _u(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of a lower-cased buffer."""
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_tables(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + _u(1)) * up[:len(b)])])
    return starts, _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _LENGTH)


def _long_text(data: bytes) -> np.ndarray:
    """Word hashes of one text, buffer by buffer, cut within white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + BUFFER)
        while end < len(data) and not _SPACE[data[end]]:  # never within a word
            end += 1
        out.append(word_hashes(data[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _texts_words(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order."""
    held, size = [], 0

    def flush():
        if held:
            starts, hashes = word_hashes(b" ".join(held))
            bounds = np.cumsum([0, *[len(t) + 1 for t in held]])
            yield from np.split(hashes, np.searchsorted(starts, bounds[1:-1]))
            held.clear()

    for t in texts:
        t = t.lower()  # bytes: A-Z alone
        if len(t) > BUFFER // 2:
            yield from flush()
            size = 0
            yield _long_text(t)
            continue
        held.append(t)
        size += len(t) + 1
        if size >= BUFFER // 2:
            yield from flush()
            size = 0
    yield from flush()


def shingle_sets(texts: Iterable[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``words`` (at most five)
    words; with fewer words the whole sequence is one, without words there is none."""
    for w in _texts_words(texts):
        n = min(len(w), words)
        if not n:
            yield np.empty(0, np.uint64)
            continue
        total = np.full(len(w) - n + 1, np.multiply(np.uint64([n]), _LENGTH)[0])
        for j in range(n):
            total += w[j:len(w) - n + 1 + j] * _PLACES[j]
        yield np.unique(_mixed(total))


def set_key(shingles: np.ndarray) -> int:
    """64-bit name of a set; equal sets have equal names."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)
