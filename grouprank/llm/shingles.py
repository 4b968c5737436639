"""Hashes of words and word shingles of many texts at once, with array operations."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Words in a shingle.
SIZE = 5
STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(STEP, -1, 1 << 64)

#: Bytes of words: letters, digits, underscore, and all bytes of characters past ASCII.
WORD_BYTES = np.array([chr(b).isalnum() or b == ord("_") or b >= 128 for b in range(128)] + [True] * 128)


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        one = np.ones(1, np.uint64)
        up = np.concatenate((one, np.cumprod(np.full(n, STEP, np.uint64))))
        down = np.concatenate((one, np.cumprod(np.full(n, INVERSE, np.uint64))))
    return up, down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-case words of all texts one after another, and where each text's begin (n + 1 places)."""
    parts = [(t or "").lower().encode() for t in texts]
    sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = WORD_BYTES[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(1 << int(len(data)).bit_length())
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])))
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    first = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    return hashes, first


def shingle_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of SIZE words, in order and with repeats, and where each text's begin (n + 1 places).

    A text of fewer words has one shingle of all its words; a text without words has none.
    """
    words, first = word_hashes(texts)
    n = np.diff(first)
    count = np.where(n >= SIZE, n - SIZE + 1, np.minimum(n, 1))
    offsets = np.concatenate(([0], np.cumsum(count)))
    starts = np.repeat(first[:-1] - offsets[:-1], count) + np.arange(offsets[-1])
    length = np.repeat(np.minimum(n, SIZE), count).astype(np.uint64)
    h = length.copy()
    padded = np.concatenate((words, np.zeros(SIZE, np.uint64)))
    for j in range(SIZE):
        w = padded[starts + j]
        h = h * np.uint64(STEP) + np.where(length > j, w, np.uint64(0))
    return mix(h), offsets
