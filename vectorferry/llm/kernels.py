"""Numpy kernels over whole Arrow batches of texts: words, shingles, sorted sets.

Functions work on the UTF-8 bytes of many texts at once, so a task spends no Python
step on a word. Words are runs of ``[^\\x20\\x09-\\x0D]``; all separators are ASCII, so
bytes can be told apart without decoding. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20  # bytes of text held in working arrays at a time; a longer text is held alone
CHUNK_ROWS = 2048  # and texts

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
SEPARATORS = (9, 10, 11, 12, 13, 32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of one odd number and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            base = np.full(size, _ODD, np.uint64)
            base[0] = 1
            self.up = np.cumprod(base, dtype=np.uint64)
            base = np.full(size, np.uint64(_inverse(int(_ODD))), np.uint64)
            base[0] = 1
            self.down = np.cumprod(base, dtype=np.uint64)
        return self.up[:n], self.down[:n]


def byte_codes(fold: bool = True) -> np.ndarray:
    """A random 64-bit code per byte; A-Z share those of a-z if folded."""
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)
    if fold:
        codes[65:91] = codes[97:123]
    return codes


def separator_table(separators: tuple[int, ...] = SEPARATORS) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with the bytes and offsets of their texts, at most ``CHUNK_BYTES`` and ``CHUNK_ROWS`` at a time.

    A null text counts as empty. Texts are never cut.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
            last = min(max(last, first + 1), first + CHUNK_ROWS, len(texts))
            begin, end = offsets[first], offsets[last]
            yield batch.slice(first, last - first), data[begin:end], offsets[first: last + 1] - begin
            first = last


class Words:
    """Words of a chunk of texts: byte ranges, hashes and the number in each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, powers: Powers,
                 separators: np.ndarray):
        inside = ~separators[data]
        start, end = inside.copy(), inside.copy()
        if len(data):
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            filled = offsets[1:] > offsets[:-1]
            heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
            start[heads] = inside[heads]
            end[tails] = inside[tails]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        up, down = powers.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
        self.hashes = mix64((sums[self.ends] - sums[self.starts]) * down[self.starts])
        edges = np.searchsorted(self.starts, offsets)
        self.first = edges[:-1]
        self.counts = np.diff(edges)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)


def _place(j: int) -> np.uint64:
    """The factor of the word at place ``j`` of a run."""
    return np.uint64(pow(int(_STEP), j, 1 << 64))


def ngram_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, and the text of each."""
    if len(words.hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(words.hashes) - size + 1
    total = words.hashes[:n].copy()
    for j in range(1, size):
        total += words.hashes[j: j + n] * _place(j)
    inside = words.owner[:n] == words.owner[size - 1:]
    return mix64(total[inside]), words.owner[:n][inside]


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after the other, and their text.

    A text of fewer than ``size`` words has one shingle, the whole sequence; a text
    without words has none.
    """
    hashes, owner = ngram_hashes(words, size)
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(size - 1):
            has = words.counts[few] > j
            short[has] += words.hashes[words.first[few[has]] + j] * _place(j)
        hashes = np.concatenate([hashes, mix64(short)])
        owner = np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    if not len(hashes):
        return hashes, owner
    edges = np.searchsorted(owner, np.arange(len(words.counts) + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a > 1:
            hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
