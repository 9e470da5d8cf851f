"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

The helpers work on the concatenated UTF-8 bytes of many texts at once, with
an offset per text, so that Python runs per batch and not per word.  Words are
maximal runs of bytes other than space and 0x09-0x0D; they never cross a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text that one call holds as arrays; a longer text stands alone.
CHUNK_BYTES = 2 << 20
# Bytes that are hashed at a time (hashing needs some 30 bytes a byte).
BLOCK_BYTES = 4 << 20

WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes and n + 1 offsets; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, at - at[0]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most `limit` bytes, one row at least."""
    if not batch.num_rows:
        return
    at = texts(batch.column(batch.schema.get_field_index(column)))[1]
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, side="right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


@dataclass
class Words:
    starts: np.ndarray  # byte where a word starts
    ends: np.ndarray  # byte after it
    first: np.ndarray  # n + 1: the first word of each text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, k: int) -> np.ndarray:
        """Index of each word that begins k words of one text."""
        n = len(self.starts)
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return np.flatnonzero(left >= k)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = WORD_BYTE[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    stops = inside[:-1] & ~inside[1:]
    tails = offsets[1:][np.diff(offsets) > 0] - 1
    stops[tails] = inside[tails]
    ends = np.flatnonzero(stops) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def _powers(base: int, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006  a cache
    if len(kept.get(base, ())) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        kept[base] = np.multiply.accumulate(steps)
    return kept[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Prefix:
    """Hashes of any spans of a sequence from one prefix sum."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * _powers(_MULTIPLIER, n), out=self.sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> Prefix:
        return cls(_BYTE_CODES[data])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * _powers(_INVERSE, len(self.sums))[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(_INVERSE))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k items from each place on; empty if there are fewer."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[k:] - self.sums[:n]) * _powers(_INVERSE, n))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    """64-bit hash of each word, block by block."""
    out = np.empty(len(w.starts), dtype=np.uint64)
    begin = 0
    while begin < len(out):
        low = w.starts[begin]
        end = max(begin + 1, int(np.searchsorted(w.ends, low + BLOCK_BYTES, side="right")))
        p = Prefix.of_bytes(data[low : w.ends[end - 1]])
        out[begin:end] = p.spans(w.starts[begin:end] - low, w.ends[begin:end] - low)
        begin = end
    return out


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys occur twice or more."""
    n = len(keys)
    found = np.zeros(n, dtype=bool)
    if n < 2:
        return found
    bits = np.uint64(int(n - 1).bit_length())
    packed = np.sort((keys >> bits << bits) | np.arange(n, dtype=np.uint64))
    top = packed >> bits
    same = np.zeros(n, dtype=bool)
    same[1:] = top[1:] == top[:-1]
    same[:-1] |= same[1:]
    maybe = (packed[same] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    if len(maybe):
        _, which, counts = np.unique(keys[maybe], return_inverse=True, return_counts=True)
        found[maybe[counts[which] > 1]] = True
    return found


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of `length` from one of `starts`."""
    steps = np.zeros(n + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:-1]) > 0


def summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i + 1]] for each i, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def expanded(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
