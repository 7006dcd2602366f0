"""Hashes of the words of a text and of runs of words, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from tokentally.llm.common import BLOCK_BYTES, blocks

#: Longer words are hashed one by one: a polynomial hash is safe for short ones only.
LONG_WORD = 256

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(20_240_607).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 12 if n <= 1 << 12 else BLOCK_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b)]))
            for b in (_BASE, inverse)
        ]
    return _powers


def word_hashes(data: bytes, apart: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash for each word of ``data``, in order.

    ``apart`` marks the 256 bytes that stand between words, white space among them;
    by itself it gives the words ``[^\\x20\\x09-\\x0D]+``.
    """
    if len(data) <= BLOCK_BYTES:
        return _block_hashes(data, apart)
    return np.concatenate([_block_hashes(b, apart) for b in blocks(data)])


def _block_hashes(data: bytes, apart: np.ndarray) -> np.ndarray:
    if len(data) > 2 * BLOCK_BYTES:  # no white space for megabytes
        words = re.split(b"[" + re.escape(bytes(np.flatnonzero(apart).tolist())) + b"]+", data)
        return np.concatenate([_block_hashes(w, apart) if len(w) <= LONG_WORD else _long(w) for w in words])
    a = np.frombuffer(data, np.uint8)
    word = np.zeros(len(a) + 2, np.int8)
    word[1:-1] = ~apart[a]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers, inverse = _power_tables(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_TABLE[a] * powers[: len(a)], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * inverse[starts])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return h


def _long(word: bytes) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(word)], np.uint64)


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, A-Z lower-cased.

    A text of fewer words gives its whole sequence as one run; one without words
    gives none.
    """
    h = word_hashes(data.lower())
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    s = h[:n].copy()
    for j in range(1, size):
        s = mix(s * np.uint64(0xC2B2AE3D27D4EB4F) + h[j : j + n])
    return np.unique(mix(s + np.uint64(size)))
