"""Hashes of words and word n-grams of many UTF-8 texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Letters, digits and all bytes of other scripts belong to words; A-Z count as a-z.
IN_WORD = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
NOT_SPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_RNG = np.random.default_rng(20240607)
VALUES = _RNG.integers(1, 1 << 63, 256, np.uint64)[LOWER]
PLACES = _RNG.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
STEPS = _RNG.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
#: Texts are hashed in groups of about so many bytes.
GROUP = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, cuts: np.ndarray, of_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts that lie between ``cuts`` in ``data``, and its text's number.

    ``of_word`` says of each byte whether it belongs to words.
    """
    inside = of_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = cuts[:-1][cuts[:-1] < len(data)]
    first[borders] = inside[borders]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    starts = np.flatnonzero(first)
    words = np.searchsorted(at, starts)
    place = np.arange(len(at)) - np.repeat(words, np.diff(np.append(words, len(at))))
    h = np.add.reduceat(mixed(VALUES[data[at]] + PLACES[place & 255] * (place + 1).astype(np.uint64)), words)
    return mixed(h), np.searchsorted(cuts, starts, "right") - 1


def ngrams(words: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of n words within a text, and the place of its first word."""
    if len(words) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = len(words) - n + 1
    h = np.zeros(size, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + size] * STEPS[k % 64]
    whole = np.flatnonzero(texts[:size] == texts[n - 1 :])
    return mixed(h[whole]), whole


def grouped(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows [a, b) of a binary column, their bytes together, and the cuts between them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + GROUP, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
