"""SentencePiece encoding and decoding by batched Viterbi.

Distinct pre-tokens of a batch are sorted by length, and those of one length
advance together: hashes of all their substrings probe the sorted keys of the
pieces, and the maximum over the pieces that end at a character, with the
first start winning ties, leaves one backpointer.

What a step scores depends on the kind of vocabulary:

- unigram: the piece's own score (a character that no piece holds: the worst
  score less a penalty);
- merges (BPE): nothing, or minus infinity if the piece can't follow the one
  that ends the best path to its start.  A cut into pieces is what the merges
  give if and only if they leave each two neighbours as they are when run on
  these two alone: merges are taken best first, so those within two
  neighbours come in the same order in either run, and a merge across their
  border would come in both.  So exactly one path survives, and it is the
  library's encoding.  Pairs are tried by running the merges, once each; a
  table of fixed size remembers them.

Decoding joins the pieces' bytes, turns U+2581 into spaces and takes off the
leading one; it gives back the text unless that holds U+2581 itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from runlens.llm import arrays as A
from runlens.llm.pieces import SPACE, Distinct, Vocabulary, vocabulary
from runlens.llm.tables import id_and_text, map_batches
from runlens.llm.token_counts import Merges, merges

MODEL = "piece_bpe_32k.model"
# Words of more characters advance alone, by a plain loop.
LONG = 256
LOW = -1e300
# The table of pairs that were tried: 2 ** SLOT_BITS sets of two, 9 bytes each.
SLOT_BITS = 21
# The table of words that were cut: 2 ** WORD_BITS, of so many characters and ids at most.
WORD_BITS, WORD_CHARS, WORD_IDS = 19, 16, 8


class Codec:
    def __init__(self, vocab: Vocabulary, of_merges: Merges | None):
        self.vocab = vocab
        self.merges = of_merges
        many = [int(i) for i in vocab.normal if len(vocab.names[i]) > 1]
        points = np.frombuffer("".join(vocab.names[i] for i in many).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.array([len(vocab.names[i]) for i in many], dtype=np.int64)
        ends = np.cumsum(sizes)
        keys = A.Prefix(vocab.codes[vocab.char[points]]).spans(ends - sizes, ends)
        order = np.argsort(keys)
        self.keys, self.piece = keys[order], np.array(many, dtype=np.int64)[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)  # by the top 20 bits, before the search
        self.maybe[self.keys >> np.uint64(44)] = True
        self.sizes = np.unique(sizes)
        self.score = np.append(vocab.scores, vocab.unknown_score)  # at the end: an unknown character
        if of_merges:
            self.score = np.append(np.zeros(of_merges.size), LOW)
            names = [*vocab.names, *of_merges.extra]
            symbols = np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32)
            self.spelt = of_merges.of_char[symbols]  # characters of each symbol
            self.spelt_first = np.concatenate([[0], np.cumsum([len(x) for x in names])])
            self.tried = np.full((1 << SLOT_BITS, 2), -1, dtype=np.int64)
            self.fits = np.zeros((1 << SLOT_BITS, 2), dtype=bool)
            whole = np.concatenate([vocab.normal, np.arange(len(vocab.names), of_merges.size)])
            self.itself = np.zeros(of_merges.size, dtype=bool)
            self.itself[whole] = of_merges.end_as(*self._spelt(whole), whole, np.full(len(whole), -1))
        self.word = np.zeros((1 << WORD_BITS, WORD_CHARS), dtype=np.uint16 if len(vocab.codes) < 1 << 16 else np.uint32)
        self.word_ids = np.zeros((1 << WORD_BITS, WORD_IDS), dtype=np.int32)
        self.word_n = np.zeros(1 << WORD_BITS, dtype=np.int8)
        raw = [b"" if i == vocab.unknown else x.replace(chr(SPACE), " ").encode() for i, x in enumerate(vocab.names)]
        for value, i in enumerate(vocab.bytes):
            raw[i] = bytes([value])
        control = set(range(len(raw))) - set(vocab.normal.tolist()) - set(vocab.bytes.tolist())
        raw = [b"" if i in control else x for i, x in enumerate(raw)]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_first = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)

    def _alone(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of characters that stand alone, and how many each has."""
        piece = self.vocab.single[points].astype(np.int64)
        if not self.vocab.byte_fallback:
            return np.where(piece < 0, self.vocab.unknown, piece), np.ones(len(points), dtype=np.int64)
        counts = self.vocab.single_counts(points)
        flat = np.repeat(piece, counts)
        lost = np.repeat(piece < 0, counts)
        if lost.any():
            raw = np.frombuffer(points[piece < 0].astype("<u4").tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
            flat[lost] = self.vocab.bytes[raw]
        return flat, counts

    def _hits(self, points: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> dict[int, np.ndarray]:
        """For each length, the piece that begins at each character, or -1.
        Pre-tokens stand one after the other in points."""
        prefix = A.Prefix(self.vocab.codes[self.vocab.char[points]])
        left = np.repeat(first + sizes, sizes) - np.arange(len(points))
        out = {1: (self.merges.of_char if self.merges else self.vocab.single)[points].astype(np.int64)}
        out[1][out[1] < 0] = len(self.score) - 1
        for size in self.sizes.tolist():
            at = np.flatnonzero(left >= size)
            if not len(at):
                break
            keys = prefix.spans(at, at + size)
            some = self.maybe[keys >> np.uint64(44)]
            at, keys = at[some], keys[some]
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            good = self.keys[place] == keys
            hit = np.full(len(points), -1, dtype=np.int64)
            hit[at[good]] = self.piece[place[good]]
            out[size] = hit
        return out

    def _spelt(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(self.spelt_first)[symbols]
        return self.spelt[np.repeat(self.spelt_first[symbols], sizes) + A.expanded(sizes)], sizes

    def _follows(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which pairs of symbols the merges leave as they are; a last of -1
        is the start of the word."""
        key = last * self.merges.size + piece
        slot = (A.mixed(key.astype(np.uint64)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        here, there = self.tried[slot, 0] == key, self.tried[slot, 1] == key
        good = np.where(last < 0, self.itself[piece], np.where(here, self.fits[slot, 0], self.fits[slot, 1]))
        known = here | there | (last < 0)
        if not known.all():
            new, at, which = np.unique(key[~known], return_index=True, return_inverse=True)
            left, right = np.divmod(new, self.merges.size)
            flat, sizes = self._spelt(np.stack([left, right], axis=1).ravel())
            found = self.merges.end_as(flat, sizes[::2] + sizes[1::2], left, right)
            good[~known] = found[which]
            slot = slot[~known][at]
            slot, at = np.unique(slot, return_index=True)  # one of those that meet in a set
            self.tried[slot, 1], self.fits[slot, 1] = self.tried[slot, 0], self.fits[slot, 0]
            self.tried[slot, 0], self.fits[slot, 0] = new[at], found[at]
        return good

    def _step(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """What each piece (-1: none) adds to the path that ends in last."""
        if not self.merges:
            return np.where(piece >= 0, self.score[piece], LOW)
        out = np.full(len(piece), LOW)
        some = np.flatnonzero(piece >= 0)
        out[some[self._follows(last[some], piece[some])]] = 0
        return out

    def _best(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each character the piece of the best cut that begins there, or
        -1; and where each word begins."""
        first = np.cumsum(sizes) - sizes
        hits = self._hits(points, first, sizes)
        chosen = np.full(len(points), -1, dtype=np.int64)
        for n in np.unique(sizes).tolist():
            at = first[sizes == n]
            if n > LONG and self.merges:  # the same cut, from a heap of pairs
                for a in at.tolist():
                    pieces = np.array(self.merges.merged_long(hits[1][a : a + n].tolist()))
                    spelt = np.diff(self.spelt_first)[pieces]
                    chosen[a + np.cumsum(spelt) - spelt] = pieces
                continue
            # very long words come one by one and keep no row per character
            groups = [at] if n <= LONG else [at[i : i + 1] for i in range(len(at))]
            for at in groups:
                best = np.full((n + 1, len(at)), LOW)
                best[0] = 0
                back = np.zeros((n + 1, len(at)), dtype=np.int16)
                last = np.full((n + 1, len(at)), -1, dtype=np.int64)
                for end in range(1, n + 1):
                    for size in sorted((x for x in hits if x <= end), reverse=True):  # the first start wins ties
                        piece = hits[size][at + (end - size)]
                        if not (piece >= 0).any():
                            continue
                        total = best[end - size] + self._step(last[end - size], piece)
                        better = total > best[end]
                        best[end][better] = total[better]
                        back[end][better] = size
                        last[end][better] = piece[better]
                place, rows = np.full(len(at), n), np.arange(len(at))
                while len(rows):
                    piece = last[place, rows]
                    place = place - back[place, rows]
                    chosen[at[rows] + place] = piece
                    rows, place = rows[place > 0], place[place > 0]
        return chosen, first

    def _cut(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that stand one after the other, and how many each has."""
        chosen, first = self._best(points, sizes)
        begins = np.flatnonzero(chosen >= 0)
        flat = chosen[begins]
        n = np.ones(len(begins), dtype=np.int64)
        lost = flat >= len(self.vocab.names)
        if lost.any():  # a character within a word that is no piece itself
            own, n[lost] = self._alone(points[begins[lost]])
            flat = np.repeat(flat, n)
            flat[np.repeat(lost, n)] = own
        before = np.concatenate([[0], np.cumsum(n)])
        return flat, np.diff(before[np.searchsorted(begins, np.append(first, len(points)))])

    def _words(self, points: np.ndarray, found: Distinct) -> tuple[np.ndarray, np.ndarray]:
        """The same for distinct words; those of earlier batches come from the
        table, if their characters are equal."""
        sizes = found.lengths
        wide = np.zeros((len(sizes), WORD_CHARS), dtype=self.word.dtype)
        short = sizes <= WORD_CHARS
        row, column = np.repeat(np.flatnonzero(short), sizes[short]), A.expanded(sizes[short])
        wide[row, column] = self.vocab.char[points[found.first[row] + column]]
        slot = (found.keys >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        known = short & (self.word_n[slot] > 0) & (self.word[slot] == wide).all(axis=1)
        n = np.where(known, self.word_n[slot], 0).astype(np.int64)
        new = np.flatnonzero(~known)
        size = sizes[new]
        flat, n_new = self._cut(points[np.repeat(found.first[new], size) + A.expanded(size)], size)
        n[new] = n_new
        out = np.empty(int(n.sum()), dtype=np.int64)
        own = np.repeat(~known, n)
        out[own] = flat
        old = np.flatnonzero(known)
        out[~own] = self.word_ids[np.repeat(slot[old], n[old]), A.expanded(n[old])]
        keep = np.flatnonzero(short[new] & (n_new <= WORD_IDS))
        _, pick = np.unique(slot[new[keep]], return_index=True)  # one of those that meet in a slot
        keep = keep[pick]
        begins = np.cumsum(n_new) - n_new
        row, column = np.repeat(slot[new[keep]], n_new[keep]), A.expanded(n_new[keep])
        self.word[slot[new[keep]]], self.word_n[slot[new[keep]]] = wide[new[keep]], n_new[keep]
        self.word_ids[row, column] = flat[np.repeat(begins[keep], n_new[keep]) + column]
        return out, n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and n + 1 offsets."""
        tokens = self.vocab.pre_tokens(texts)
        lengths = tokens.lengths
        counts = np.zeros(len(lengths), dtype=np.int64)
        source = np.zeros(len(lengths), dtype=np.int64)  # where a pre-token's ids begin
        alone = np.flatnonzero(lengths == 1)
        ids, n = self._alone(tokens.points[tokens.first[alone]])
        counts[alone], source[alone] = n, np.cumsum(n) - n
        found = self.vocab.distinct(tokens)
        if len(found.picked):
            flat, n = self._words(tokens.points, found)
            counts[found.picked] = n[found.which]
            source[found.picked] = len(ids) + (np.cumsum(n) - n)[found.which]
            ids = np.concatenate([ids, flat])
        out = ids[np.repeat(source, counts) + A.expanded(counts)]
        return out.astype(np.int32), np.concatenate([[0], np.cumsum(A.summed(counts, tokens.text_first))])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts, one after the other, and n + 1 offsets."""
        sizes = np.diff(self.raw_first)[ids]
        data = self.raw[np.repeat(self.raw_first[ids], sizes) + A.expanded(sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        if self.vocab.prefix:
            heads = ends[:-1][np.diff(ends) > 0]
            heads = heads[data[heads] == 32]
            lost = np.zeros(len(data) + 1, dtype=np.int64)
            lost[heads + 1] = 1
            keep = np.ones(len(data), dtype=bool)
            keep[heads] = False
            return data[keep], ends - np.cumsum(lost)[ends]
        return data, ends


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    vocab = vocabulary(model)
    return Codec(vocab, merges(model) if vocab.by_merges else None)


def _encoded(part: pa.RecordBatch, at: int, model: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids as a list column, tokens a row, and whether decoding gives the text."""
    c = codec(model)
    data, offsets = A.texts(part.column(at))
    ids, first = c.encode([x or "" for x in part.column(at).to_pylist()])
    again, ends = c.decode(ids, first)
    if np.array_equal(ends, offsets):
        wrong = np.flatnonzero(again != data)
        same = np.ones(len(offsets) - 1, dtype=bool)
        same[np.searchsorted(offsets, wrong, side="right") - 1] = False
    else:
        raw, back = data.tobytes(), again.tobytes()
        same = np.array([raw[a:b] == back[x:y] for a, b, x, y in zip(offsets[:-1], offsets[1:], ends[:-1], ends[1:], strict=True)], dtype=bool)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)), np.diff(first), same


def encoded(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: ids, their number, and whether decoding
    them gives the text back.  A null or empty text has no ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                ids, n, same = _encoded(part, 1, model)
                size = np.diff(A.texts(part.column(1))[1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.array(n), ids, pa.array(same)], names=["doc_id", "n_bytes", "n_tokens", "token_ids", "round_trip"])

    return map_batches(id_and_text(docs, id_col, text_col), rows, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, token_ids array<int>, round_trip boolean")


def with_ids(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """docs with `token_ids` and `n_tokens` put behind their columns (in place
    of columns of these names)."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("token_ids", "n_tokens")]
    schema = T.StructType([*kept, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch, text_col):
                ids, n, _ = _encoded(part, part.schema.get_field_index(text_col), model)
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(n)], names=[*part.schema.names, "token_ids", "n_tokens"])

    return map_batches(docs.select(*[f"`{f.name}`" for f in kept]), rows, schema)


def decoded(rows: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, text) of each row's ids; null ids give an empty text."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy().astype(np.int64)
            sizes = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            data, ends = c.decode(ids, np.concatenate([[0], np.cumsum(sizes)]))
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())], names=["doc_id", "text"])

    return map_batches(rows.select(f"`{id_col}`", f"`{ids_col}`"), texts, f"doc_id {rows.schema[id_col].dataType.simpleString()}, text string")
