"""Token counts: byte-pair merges of many pre-tokens at once.

Pre-tokens of a batch are ragged numpy arrays of symbols.  In each round every
sequence merges its best pair (lowest rank, the leftmost of equals), all
sequences at the same time; a sequence that has no pair left drops out with
the number of its symbols.  Equal pre-tokens of a batch are merged once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runlens.llm import arrays as A
from runlens.llm.pieces import Vocabulary, vocabulary
from runlens.llm.tables import id_and_text, map_batches

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# Rounds grow with a sequence's length; longer ones take their pairs from a heap.
LONG = 1024
NEVER = np.int64(1 << 62)
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merges:
    """Ranks of all pairs of symbols; a symbol is a piece or a character."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        names = {vocab.names[i]: int(i) for i in vocab.normal}
        self.extra = extra = sorted({c for x in names if len(x) > 1 for c in x} - set(names))
        symbols = {**names, **{c: len(vocab.names) + i for i, c in enumerate(extra)}}
        self.size = len(vocab.names) + len(extra)
        # what a symbol that survives counts: characters without a piece fall back to bytes
        self.counts = np.ones(self.size, dtype=np.int64)
        if vocab.byte_fallback:
            self.counts[len(vocab.names) :] = [len(c.encode()) for c in extra]
        self.of_char = vocab.single.astype(np.int64)
        for c in extra:
            self.of_char[ord(c)] = symbols[c]
        _, rank = np.unique(-vocab.scores[vocab.normal], return_inverse=True)
        rank_of = dict(zip(vocab.normal.tolist(), rank.tolist(), strict=True))
        pairs = {}
        for name, i in names.items():
            for k in range(1, len(name)):
                left, right = symbols.get(name[:k]), symbols.get(name[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (rank_of[i], i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the keys, or -1."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merges sequences (none empty) and yields those that are done, with
        the round that they end in: their numbers, lengths and symbols."""
        first = np.concatenate([[0], np.cumsum(lengths)])
        for i in np.flatnonzero(lengths > LONG).tolist():
            left = self.merged_long(symbols[first[i] : first[i + 1]].tolist())
            yield np.array([i]), np.array([len(left)]), np.array(left, dtype=np.int64)
        if len(lengths) and lengths.max() > LONG:
            symbols = symbols[np.repeat(lengths <= LONG, lengths)]
        owner = np.flatnonzero(lengths <= LONG)
        lengths = lengths[owner]
        ends = np.cumsum(lengths)
        pair = np.full(len(symbols), -1, dtype=np.int64)
        if len(symbols) > 1:
            pair[:-1] = self.look_up(symbols[:-1], symbols[1:])
            pair[ends - 1] = -1
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            key = np.where(pair >= 0, (self.ranks[pair] << np.int64(32)) | np.arange(len(pair)), NEVER)
            best = np.minimum.reduceat(key, starts)
            open_ = best < NEVER
            at = best & np.int64(0xFFFFFFFF)
            if not open_.all():
                stays = np.repeat(open_, lengths)
                yield owner[~open_], lengths[~open_], symbols[~stays]
                at = at[open_] - np.cumsum(~stays)[at[open_]]
                symbols, pair = symbols[stays], pair[stays]
                owner, lengths = owner[open_], lengths[open_]
            if not len(owner):
                break
            symbols[at] = self.merged[pair[at]]
            stays = np.ones(len(symbols), dtype=bool)
            stays[at + 1] = False
            symbols, pair = symbols[stays], pair[stays]
            at = at - np.arange(len(at))
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            starts = ends - lengths
            inner = at < ends - 1
            pair[at] = -1
            pair[at[inner]] = self.look_up(symbols[at[inner]], symbols[at[inner] + 1])
            inner = at > starts
            pair[at[inner] - 1] = self.look_up(symbols[at[inner] - 1], symbols[at[inner]])

    def count(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving tokens of each sequence."""
        out = np.zeros(len(lengths), dtype=np.int64)
        for owner, left, flat in self.rounds(symbols, lengths):
            out[owner] = np.add.reduceat(self.counts[flat], np.cumsum(left) - left)
        return out

    def end_as(self, symbols: np.ndarray, lengths: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which sequences end as these two symbols (second < 0: as one)."""
        out = np.zeros(len(lengths), dtype=bool)
        for owner, left, flat in self.rounds(symbols, lengths):
            starts = np.cumsum(left) - left
            good = (left == np.where(second[owner] < 0, 1, 2)) & (flat[starts] == first[owner])
            out[owner] = good & ((second[owner] < 0) | (flat[starts + left - 1] == second[owner]))
        return out

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist(), strict=True), strict=True))

    def merged_long(self, s: list[int]) -> list[int]:
        """The same merges of one sequence, best pair first from a heap."""
        n = len(s)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(p[0], i, s[i], s[i + 1]) for i in range(n - 1) if (p := self.pairs.get(s[i] * self.size + s[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or s[i] != left or s[j] != right:
                continue
            s[i] = self.pairs[left * self.size + right][1]
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := self.pairs.get(s[a] * self.size + s[b])):
                    heapq.heappush(heap, (p[0], a, s[a], s[b]))
        return [x for x, lives in zip(s, alive, strict=True) if lives]


@lru_cache(maxsize=2)
def merges(model: str) -> Merges:
    return Merges(vocabulary(model))


def token_counts_of(texts: list[str], model: str = MODEL) -> np.ndarray:
    m = merges(model)
    tokens = m.vocab.pre_tokens(texts)
    counts = np.zeros(len(tokens.lengths), dtype=np.int64)
    alone = tokens.lengths == 1
    counts[alone] = m.vocab.single_counts(tokens.points[tokens.first[:-1][alone]])
    found = m.vocab.distinct(tokens)
    if len(found.picked):
        flat = tokens.points[np.repeat(found.first, found.lengths) + A.expanded(found.lengths)]
        counts[found.picked] = m.count(m.of_char[flat], found.lengths)[found.which]
    return A.summed(counts, tokens.text_first)


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: bytes, tokens, and whether it has more
    tokens than `limit`.  A null or empty text has none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                n = token_counts_of(part.column(1).to_pylist(), model)
                size = np.diff(A.texts(part.column(1))[1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(id_and_text(docs, id_col, text_col), rows, SCHEMA.replace("doc_id long", f"doc_id {docs.schema[id_col].dataType.simpleString()}"))
