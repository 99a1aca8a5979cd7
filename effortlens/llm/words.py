"""Words and word n-grams of whole Arrow batches as hash arrays.

A word is a maximal run of digits, ASCII letters and characters beyond ASCII, with A-Z
lower-cased. All of a batch's texts are handled in one go: bytes are classified by a table,
word hashes are differences of a running polynomial sum modulo 2**64, and n-gram hashes are
combined from word hashes. Slices of bounded size keep the arrays small whatever the batch
holds; only a single text longer than a slice makes a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_TEXTS = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.zeros(256, np.uint8)
for _code in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _LOWER[_code] = _code
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x + _ODD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    base = 0x100000001B3
    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) >= n:
            return cls.up, cls.down
        inverse = pow(cls.base, -1, 1 << 64)
        size = max(n, SLICE_BYTES + 1)
        up, down = (
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))])
            for b in (np.uint64(cls.base), np.uint64(inverse))
        )
        if size == SLICE_BYTES + 1:  # longer ones, for a word of that length, are not kept
            cls.up, cls.down = up, down
        return up, down


@dataclass
class Words:
    """Words of some texts: text ``t`` has the words ``first[t]`` to ``first[t + 1]``."""

    lower: np.ndarray  # bytes with A-Z lower-cased, 0 between words
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self)), self.counts)

    def word(self, i: int) -> str:
        return self.lower[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _find(data: np.ndarray, offsets: np.ndarray) -> Words:
    lower = _LOWER[data]
    inside = lower != 0
    size = len(data)
    fresh = np.zeros(size + 1, bool)
    fresh[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    start = np.flatnonzero(inside & (fresh[:-1] | ~before))
    end = np.flatnonzero(inside & (fresh[1:] | ~after)) + 1
    code = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # a few words at a time, however long the text
        to = max(at + 1, int(np.searchsorted(end, start[at] + SLICE_BYTES, "right")))
        low, high = start[at], end[to - 1]
        up, down = _Powers.upto(int(high - low) + 1)
        run = np.zeros(high - low + 1, np.uint64)
        np.cumsum(lower[low:high] * up[: high - low], dtype=np.uint64, out=run[1:])
        code[at:to] = (run[end[at:to] - low] - run[start[at:to] - low]) * down[start[at:to] - low]
        at = to
    first = np.searchsorted(start, offsets)
    return Words(lower, start, end, first, mix(code + (end - start).astype(np.uint64)))


def slices(
    texts: pa.Array, size: int = SLICE_BYTES, most: int = SLICE_TEXTS
) -> Iterator[tuple[int, int, Words]]:
    """Words of consecutive ranges of texts: (from, to, words).

    A range is of about ``size`` bytes and at most ``most`` texts; only these are copied.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at, n = 0, len(texts)
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        to = min(to, at + most)
        yield at, to, _find(*text_bytes(texts.slice(at, to - at)))
        at = to


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside one text, and the index of their first word."""
    h, count = words.hash, len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = h[:count].copy()
    for j in range(1, n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + h[j : j + count]
    text = words.text
    at = np.flatnonzero(text[:count] == text[n - 1 :])
    return mix(total[at] + np.uint64(n)), at


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words and the text of each, as two arrays ordered by text.

    A text of fewer than ``n`` words, but not none, has all its words as one shingle.
    """
    code, at = ngrams(words, n)
    text = words.text[at]
    for t in np.flatnonzero((words.counts > 0) & (words.counts < n)):
        run = words.hash[words.first[t] : words.first[t + 1]]
        one = run[:1].copy()
        for h in run[1:]:
            one = one * np.uint64(0xD6E8FEB86659FD93) + h
        code = np.append(code, mix(one + np.uint64(len(run))))
        text = np.append(text, t)
    order = np.argsort(text, kind="stable")
    return code[order], text[order]
