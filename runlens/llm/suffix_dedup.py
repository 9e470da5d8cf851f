"""Suffix-array dedup: blockwise suffix sorting with a difference cover.

Suffixes are sorted one bucket at a time: a bucket holds the suffixes whose
first `length` bytes have the same anchor (see `repeats`), and equal strings
of that length share a bucket.  Within a block of buckets,

- stretches that are equal as a whole are sorted once;
- a sample of the suffixes, those whose place modulo v lies in a difference
  cover D, is ranked by its first v bytes, then by 2 v, 4 v, ... bytes from
  pairs of ranks (a sample's place plus v is a sample again);
- all suffixes are ranked by their first v bytes; ties are resolved by ranks
  of the cover sample, at the first shift that brings them into it (stretches
  are laid out so that anchors are multiples of v, hence equal strings reach
  it by the same shift), then by the last bytes.

Suffixes that end with the same rank agree in `length` bytes.  Memory is bound
by a block's bytes; only the sample's ranks are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.repeats import HOT, Anchors, Method, window_anchors, without_repeats

PERIOD = 16


def difference_cover(v: int) -> list[int]:
    """A set whose pairwise differences modulo v are all of 0..v-1 (greedy)."""
    cover = [0]
    while True:
        have = {(a - b) % v for a in cover for b in cover}
        if len(have) == v:
            return sorted(cover)
        cover.append(max(range(v), key=lambda x: len({(x - a) % v for a in cover} | {(a - x) % v for a in cover} | have) if x not in cover else 0))


COVER = difference_cover(PERIOD)


def _ranks(rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Dense ranks of (rank, key), both below 2 ** 32."""
    both = rank.astype(np.uint64) << np.uint64(32) | key.astype(np.uint64)
    return np.unique(both, return_inverse=True)[1]


def _fours(text: np.ndarray) -> np.ndarray:
    """The four bytes from each place on, as a number that sorts like them."""
    t = np.concatenate([text, np.zeros(4, dtype=np.uint8)]).astype(np.uint32)
    return t[:-4] << np.uint32(24) | t[1:-3] << np.uint32(16) | t[2:-2] << np.uint32(8) | t[3:-1]


def string_ranks(text: np.ndarray, ends: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Rank of each string text[s:s + length] within its bucket and residue:
    equal ranks for equal strings only, -1 for a string that is alone.

    `ends` holds, for each place of text, the end of its stretch.  Suffixes of
    one bucket that are equal must agree modulo PERIOD.
    """
    fours = _fours(text)
    place = np.arange(len(text))
    sample = np.flatnonzero(np.isin(place % PERIOD, COVER) & (place + PERIOD <= ends))
    levels = []
    rank = np.zeros(len(sample), dtype=np.int64)
    for j in range(0, PERIOD, 4):
        rank = _ranks(rank, fours[sample + j])
    depth = PERIOD
    while True:
        ranks_at = np.zeros(len(text), dtype=np.uint32)
        ranks_at[sample] = rank
        levels.append((depth, ranks_at))
        if 2 * depth > length - PERIOD:
            break
        more = sample + 2 * depth <= ends[sample]
        sample = sample[more]
        rank = _ranks(rank[more], ranks_at[sample + depth])
        depth *= 2
    shift = np.array([min(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in range(PERIOD)])
    out = np.full(len(starts), -1, dtype=np.int64)
    tied = np.arange(len(starts))
    # suffixes of different residues take different shifts and are never equal
    rank = _ranks(np.unique(bucket, return_inverse=True)[1], starts % PERIOD)
    keys = [lambda s, j=j: fours[s + j] for j in range(0, PERIOD, 4)]
    rest, gone = length - PERIOD, 0
    for depth, ranks_at in reversed(levels):
        while rest >= depth:
            keys.append(lambda s, g=gone, r=ranks_at: r[s + shift[s % PERIOD] + g])
            rest, gone = rest - depth, gone + depth
    tail = -(-(PERIOD + rest) // 4) * 4  # what the sample may leave at the end
    keys += [lambda s, j=j: fours[s + length - tail + j] for j in range(0, tail, 4)]
    for key in keys:
        rank = _ranks(rank, key(starts[tied]))
        many = np.bincount(rank)[rank] > 1  # a string alone needs no more bytes
        tied, rank = tied[many], rank[many]
        if not len(tied):
            break
    out[tied] = rank
    return out


@dataclass(frozen=True)
class SuffixBuckets(Method):
    length: int = 400
    gram: int = 24

    def __post_init__(self):
        if self.length < 2 * PERIOD or self.length < self.gram:
            raise ValueError(f"length must be {2 * PERIOD} at least")

    def sizes(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.diff(offsets)

    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Anchors]:
        n = np.diff(offsets)
        windows = np.maximum(n - self.length + 1, 0)
        begins = np.repeat(offsets[:-1], windows) + A.expanded(windows)
        grams = A.Prefix.of_bytes(data).grams(self.gram)
        return n, window_anchors(grams, self.length - self.gram + 1, begins, np.repeat(np.arange(len(n)), windows), offsets[:-1])

    def stretches(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> list[bytes]:
        raw = data.tobytes()
        base = offsets[found.text]
        return [raw[a:b] for a, b in zip((base + found.begin).tolist(), (base + found.end - 1 + self.length).tolist(), strict=True)]

    def window_keys(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> np.ndarray:
        sizes = found.end - found.begin
        at = np.repeat(offsets[found.text] + found.begin, sizes) + A.expanded(sizes)
        return A.Prefix.of_bytes(data).spans(at, at + self.length)

    def repeated(self, bucket: np.ndarray, lead: np.ndarray, sizes: np.ndarray, stretches: list[bytes]) -> np.ndarray:
        row_of: dict[tuple[int, int, bytes], int] = {}
        same = np.array([row_of.setdefault(x, i) for i, x in enumerate(zip(bucket.tolist(), lead.tolist(), stretches, strict=True))], dtype=np.int64)
        copies = np.bincount(same, minlength=len(same))
        distinct = np.flatnonzero(copies)
        _, which, together = np.unique(bucket[distinct], return_inverse=True, return_counts=True)
        sort = distinct[together[which] > 1]  # buckets with different stretches
        first = np.cumsum(sizes) - sizes
        mask = np.repeat(copies > 1, sizes)
        if len(sort):
            pads = (-lead[sort]) % PERIOD
            lengths = np.array([len(stretches[i]) for i in sort], dtype=np.int64)
            room = -(-(pads + lengths) // PERIOD) * PERIOD
            begin = np.cumsum(room) - room + pads
            text = np.zeros(int(room.sum()), dtype=np.uint8)
            ends = np.zeros(len(text), dtype=np.int64)
            inside = np.repeat(begin, lengths) + A.expanded(lengths)
            text[inside] = np.frombuffer(b"".join(stretches[i] for i in sort), dtype=np.uint8)
            ends[inside] = np.repeat(begin + lengths, lengths)
            starts = np.repeat(begin, sizes[sort]) + A.expanded(sizes[sort])
            ranks = string_ranks(text, ends, starts, np.repeat(bucket[sort], sizes[sort]), self.length)
            mask[np.repeat(first[sort], sizes[sort]) + A.expanded(sizes[sort])] |= ranks >= 0
        # copies have the marks of the stretch that stood for them
        other = np.flatnonzero(same != np.arange(len(same)))
        mask[np.repeat(first[other], sizes[other]) + A.expanded(sizes[other])] = mask[np.repeat(first[same[other]], sizes[other]) + A.expanded(sizes[other])]
        return mask

    def kept(self, text: bytes, covered: np.ndarray | None) -> bytes:
        return text if covered is None else np.frombuffer(text, dtype=np.uint8)[~covered].tobytes()


def suffix_dedup(docs: DataFrame, length: int = 400, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs:
    UTF-8 bytes outside all strings of `length` bytes that also start
    elsewhere.  A null or empty text has no bytes and the digest of none."""
    found = without_repeats(docs, SuffixBuckets(length), hot, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
