"""Hashes of word shingles, for a block of texts at once.

Words are what blanks and the signs U+0009 to U+000D leave. A block takes a few passes over its
bytes and no loop over words: the hash of a word is a polynomial of its bytes modulo 2**64, mixed;
that of a shingle mixes those of its words in their order.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    steps = np.full(max(n, 1), _BASE, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def shingles(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts one after another, and how many each text has.

    A text of fewer words is one shingle as a whole, one without words has none.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    is_word = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    start, length = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.cumsum(length) - length
    offset = np.arange(int(length.sum())) - np.repeat(first, length)
    word = mix(np.add.reduceat((raw[is_word] + np.uint64(1)) * _powers(int(length.max()))[offset], first))
    text = np.searchsorted(ends, start, "left")
    words = np.bincount(text, minlength=len(ends))
    begin = np.cumsum(words) - words
    counts = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
    # The shingle at word i joins the next words, as far as the text goes.
    at = np.arange(len(word))
    left = np.minimum((begin + words)[text] - at, size)
    whole = np.zeros(len(word), np.uint64)
    for k in range(size):
        whole = np.where(left > k, mix(whole * _ODD + word[np.minimum(at + k, len(word) - 1)]), whole)
    return whole[at - begin[text] < counts[text]], counts
