"""Runs of words that repeat with a period, by recursive frequency splitting.

A qualifying run holds its period four times or more, so each of its words
occurs four times or more in any segment that holds the run.  Words that are
rarer in a segment can't belong to a run there: they split it, and the parts
are counted anew, until no segment has a rare word.  What survives is little
of most texts.

A surviving segment is scanned lag by lag.  A run that holds a period of q
words four times covers three whole blocks of the grid of q-word blocks, so
for lag q only the n / q blocks are compared, by hashes from one prefix sum;
three equal neighbours are then compared word by word and extended both ways.
That makes n log n block comparisons for all lags.  Hashes only say where to
look: words are told apart by themselves.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.tables import id_and_text, map_batches

# Bytes of a text that are held as separate words at a time.
PART_BYTES = 1 << 20
# Words that are joined at a time.
PART_WORDS = 1 << 18
BLANK = re.compile(rb"[ \t-\r]")
# Odd, so that its powers have inverses.
STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Periodic:
    """A run has `least_length` words and holds its period `times` times."""

    least_length: int = 6
    times: int = 4

    def __post_init__(self):
        if self.times < 3:
            raise ValueError("a run holds its period 3 times at least")


def word_ids(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word of a text, and the word of each number."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    parts, begin = [], 0
    while begin < len(text):
        cut = BLANK.search(text, begin + PART_BYTES)
        end = cut.start() if cut else len(text)
        words = text[begin:end].split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), list(known)


def survivors(ids: np.ndarray, rules: Periodic) -> list[tuple[int, int]]:
    """(start, end) of the segments in which no word is rare."""
    found: list[tuple[int, int]] = []
    starts, ends = np.array([0]), np.array([len(ids)])
    while len(starts):
        sizes = ends - starts
        of = np.repeat(np.arange(len(starts)), sizes)
        at = A.expanded(sizes) + np.repeat(starts, sizes)
        if len(starts) == 1:
            rare = np.bincount(ids[at])[ids[at]] < rules.times
        else:
            _, which, counts = np.unique(of * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
            rare = counts[which] < rules.times
        split = np.zeros(len(starts), dtype=bool)
        split[of[rare]] = True
        found += zip(starts[~split].tolist(), ends[~split].tolist(), strict=True)
        left = at[~rare & split[of]]
        heads = np.flatnonzero(np.diff(left, prepend=-2) != 1)
        starts, ends = left[heads], left[np.append(heads[1:], len(left)) - 1] + 1 if len(left) else left
        long = ends - starts >= rules.least_length
        starts, ends = starts[long], ends[long]
    return sorted(x for x in found if x[1] - x[0] >= rules.least_length)


def _extended(seg: np.ndarray, q: int, a: int, b: int) -> tuple[int, int]:
    """The maximal stretch around a..b where a word equals that q words on."""
    size = 64
    while a > 0:
        low = max(0, a - size)
        differ = np.flatnonzero(seg[low:a] != seg[low + q : a + q])
        if len(differ):
            a = low + int(differ[-1]) + 1
            break
        a, size = low, 2 * size
    size = 64
    while b + q < len(seg):
        high = min(len(seg) - q, b + size)
        differ = np.flatnonzero(seg[b:high] != seg[b + q : high + q])
        if len(differ):
            b += int(differ[0])
            break
        b, size = high, 2 * size
    return a, b


def lag_scan(seg: np.ndarray, rules: Periodic) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the maximal runs of a segment.

    A stretch of three blocks that lies in a run found at a smaller lag has
    that run's period too (both periods hold over it, so their divisor does),
    and is no run of its own.
    """
    n, t = len(seg), rules.times
    powers = np.full(n + 1, STEP, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(A.mixed(seg.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    reach = np.zeros(n, dtype=np.int64)  # the furthest end of a run over each word
    found = []
    for q in range(1, n // t + 1):
        blocks = np.diff(sums[::q])
        same = blocks[1:] == blocks[:-1] * powers[q]
        # t - 1 equal blocks in a row
        hits = same[: len(same) - t + 3].copy()
        for i in range(1, t - 2):
            hits &= same[i : len(same) - t + 3 + i]
        if not hits.any():
            continue
        at = np.flatnonzero(hits)
        heads = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        first, last = at[heads] * q, (at[np.append(heads[1:], len(at)) - 1] + t - 1) * q
        new = reach[first] < last
        for a, b in zip(first[new].tolist(), last[new].tolist(), strict=True):
            equal = np.flatnonzero(seg[a : b - q] == seg[a + q : b])  # all, unless hashes collide
            cuts = np.flatnonzero(np.diff(equal, prepend=-2) != 1)
            for i, j in pairwise([*cuts.tolist(), len(equal)]):
                x, y = _extended(seg, q, a + int(equal[i]), a + int(equal[j - 1]) + 1)
                length = y + q - x
                if length >= max(rules.least_length, t * q) and reach[x] < y + q:
                    found.append((x, length, q))
                    np.maximum(reach[x : y + q], y + q, out=reach[x : y + q])
    return found


def runs_of(ids: np.ndarray, rules: Periodic) -> list[tuple[int, int, int]]:
    """(start, length, period) of a text's runs, by start, then period."""
    found = []
    for lo, hi in survivors(ids, rules):
        found += [(lo + a, length, q) for a, length, q in lag_scan(ids[lo:hi], rules)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(ids: np.ndarray, words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, each run cut to its first period."""
    gone = np.zeros(len(ids) + 1, dtype=np.int32)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    left = ids[np.cumsum(gone[:-1]) == 0]
    return b" ".join(b" ".join(map(words.__getitem__, left[i : i + PART_WORDS].tolist())) for i in range(0, len(left), PART_WORDS))


def periodic_runs(docs: DataFrame, rules: Periodic = Periodic(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period)
    and collapsed, the text with one period of each run.

    A null or empty text has no words and no run; repeated rows and null ids
    get a row each; no rows give none; other columns aren't read.  A run is
    reported with its smallest period; runs of different periods may overlap,
    and a word goes if it is past the first period of any of them.
    """
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                counts, runs, texts = [], [], []
                for text in part.column(1):
                    ids, words = word_ids(text.as_buffer().to_pybytes())
                    found = runs_of(ids, rules)
                    counts.append(len(ids))
                    runs.append([dict(zip(("start", "length", "period"), x, strict=True)) for x in found])
                    texts.append(collapsed(ids, words, found))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(runs, run), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(docs, id_col, text_col), rows, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def cycled(text: bytes, h: int) -> bytes:
    """The text whose words from some place on go round in a cycle, place and
    length by h, if h ends in 0."""
    if h % 10:
        return text
    words = text.split()
    n, g = len(words), h // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    return b" ".join(words[:a] + words[a : a + p] * times + words[a : a + rest])


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text; `cycled` by the CRC-32 of the decimal id, a document
    without id as it is."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                ids = part.column(0).to_pylist()
                texts = [t.as_buffer().to_pybytes() if i is None else cycled(t.as_buffer().to_pybytes(), zlib.crc32(str(i).encode())) for i, t in zip(ids, part.column(1), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    rows_of = id_and_text(docs, id_col, text_col)
    return map_batches(rows_of, rows, rows_of.schema)


def run_report(docs: DataFrame, rules: Periodic = Periodic(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: the number of runs, the longest (ties: first, then
    smallest period; nulls if there is none), and SHA-256 digests of the runs
    and of the collapsed text.  Cases as in `periodic_runs`."""
    found = periodic_runs(docs, rules, id_col, text_col)
    longest = F.expr("array_max(transform(runs, x -> struct(x.length AS length, -x.start AS start, -x.period AS period)))")
    lines = F.expr(r"array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
