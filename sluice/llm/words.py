"""Words and shingles of many texts at once, as flat numpy arrays.

A text is its UTF-8 bytes. Both kinds of word are runs of bytes of a class, as every byte of a character
beyond ASCII is a word byte in both. A word's hash is a polynomial of random byte values modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about this many bytes; one longer text is a piece of its own.
PIECE_BYTES = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_class(separators) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


#: Bytes of words: everything but white space; or letters and digits with everything beyond ASCII.
NOT_SPACE = _byte_class([0x20, *range(0x09, 0x0E)])
LETTERS = _byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier or of its inverse, kept between calls up to a few pieces."""
    have = _powers[kind]
    if len(have) < n:
        have = np.full(max(n, 2 * PIECE_BYTES), _MULTIPLIER if kind == "up" else _INVERSE, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 4 * PIECE_BYTES:
            _powers[kind] = have
    return have[:n]


class Words:
    """Words of ``texts``: byte spans, hashes, and where each text's words begin."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.raw = buf
        self.buf = buf = _LOWER[buf]
        is_word = kind[buf]
        first, last = offsets[:-1], offsets[1:]
        full = last > first
        before = np.empty(len(buf), dtype=bool)
        before[:1] = False
        before[1:] = is_word[:-1]
        before[first[full]] = False
        after = np.empty(len(buf), dtype=bool)
        after[-1:] = False
        after[:-1] = is_word[1:]
        after[last[full] - 1] = False
        self.starts = np.flatnonzero(is_word & ~before)
        self.ends = np.flatnonzero(is_word & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i] .. bounds[i + 1]
        self.counts = np.diff(self.bounds)
        if len(self.starts):
            values = _VALUES[buf] * _power("up", len(buf))
            values[~is_word] = 0
            self.hashes = mix(np.add.reduceat(values, self.starts) * _power("down", len(buf))[self.starts])
        else:
            self.hashes = np.zeros(0, dtype=np.uint64)

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on, also across texts; the caller knows which are whole."""
        n = max(0, len(self.hashes) - k + 1)
        out = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            out = (out + self.hashes[j:n + j]) * np.uint64(_MULTIPLIER)
        return mix(out + np.uint64(k))

    def text(self, a: int, b: int) -> str:
        """Lower-cased words ``a`` up to ``b``, joined by one space."""
        return b" ".join(self.buf[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])).decode("utf-8", "replace")


def pieces(texts: pa.Array, kind: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over a column of strings; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, j, Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], kind)
        i = j


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles of every text: (hashes sorted within a text, bounds per text).

    A text of fewer words, but not none, has its whole sequence as its one shingle."""
    n = np.where(words.counts >= k, words.counts - k + 1, (words.counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    at = words.bounds[:-1][doc] + within
    whole = words.counts[doc] >= k
    hashes = np.zeros(len(doc), dtype=np.uint64)
    if whole.any():
        hashes[whole] = words.shingles(k)[at[whole]]
    for i in np.flatnonzero(~whole):
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for x in words.hashes[words.bounds[doc[i]]:words.bounds[doc[i] + 1]]:
                h = (h + x) * np.uint64(_MULTIPLIER)
        hashes[i] = mix(np.array([h + np.uint64(words.counts[doc[i]])], dtype=np.uint64))[0]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[keep], doc[keep]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))
