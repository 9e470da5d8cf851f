"""A SentencePiece vocabulary as arrays, and texts cut where no piece can lie.

No piece of the vocabulary holds two neighbouring characters that no piece
holds side by side, so a text may be cut between them: the parts (pre-tokens)
are encoded alone, equal ones once.  With the usual vocabularies the parts are
words with their leading space, or less.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from runlens.llm import arrays as A

SPACE = 0x2581  # stands for U+0020 in pieces
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6  # kinds of pieces, fixed by the format
BPE = 2  # the model type of merges; 1 is unigram
UNK_PENALTY = 10.0  # fixed: an unknown character scores so much below the worst piece
CODE_POINTS = 0x110000


@dataclass
class PreTokens:
    points: np.ndarray  # code points of all texts, spaces escaped
    first: np.ndarray  # where each pre-token begins, and the end
    text_first: np.ndarray  # first pre-token of each text, and the end

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.first)


@dataclass
class Distinct:
    """Pre-tokens of two or more characters, each content once."""

    picked: np.ndarray  # places of all such pre-tokens
    which: np.ndarray  # their content's number
    first: np.ndarray  # where one of that content begins
    lengths: np.ndarray
    keys: np.ndarray  # its hash


class Vocabulary:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only vocabularies that leave texts as they are can be used")
        self.prefix = rules.add_dummy_prefix
        self.by_merges = model.trainer_spec.model_type == BPE
        self.names = [p.piece for p in model.pieces]
        kinds = np.array([p.type for p in model.pieces])
        self.scores = np.array([p.score for p in model.pieces], dtype=np.float64)
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.bytes = np.flatnonzero(kinds == BYTE)
        self.byte_fallback = len(self.bytes) == 256
        if (kinds == USER_DEFINED).any():
            raise ValueError("user-defined pieces aren't supported")
        self.normal = np.flatnonzero(kinds == NORMAL)
        self.unknown_score = self.scores[self.normal].min() - UNK_PENALTY
        self.longest = max(len(self.names[i]) for i in self.normal)
        self.single = np.full(CODE_POINTS, -1, dtype=np.int32)  # piece of a character
        together = sorted({c for i in self.normal if len(self.names[i]) > 1 for c in self.names[i]})
        self.char = np.zeros(CODE_POINTS, dtype=np.int32)  # number among those, from 1
        for n, c in enumerate(together, 1):
            self.char[ord(c)] = n
        self.together = np.zeros((len(together) + 1,) * 2, dtype=bool)
        for i in self.normal:
            name = self.names[i]
            if len(name) == 1:
                self.single[ord(name)] = i
            numbers = self.char[[ord(c) for c in name]]
            self.together[numbers[:-1], numbers[1:]] = len(name) > 1
        self.codes = np.random.default_rng(7).integers(1, 1 << 63, len(together) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def pre_tokens(self, texts: list[str]) -> PreTokens:
        """Cuts texts; an empty one has no pre-token, not even the prefix."""
        lead = chr(SPACE) if self.prefix else ""
        joined = "".join([lead + x if x else "" for x in texts])
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
        points[points == 32] = SPACE
        begins = np.concatenate([[0], np.cumsum([len(x) + len(lead) if x else 0 for x in texts])]).astype(np.int64)
        chars = self.char[points]
        cut = np.ones(len(points), dtype=bool)
        cut[1:] = ~self.together[chars[:-1], chars[1:]]
        cut[begins[:-1][begins[:-1] < len(points)]] = True
        first = np.flatnonzero(cut)
        return PreTokens(points, np.append(first, len(points)), np.searchsorted(first, begins))

    def distinct(self, tokens: PreTokens) -> Distinct:
        """Groups equal pre-tokens by hash, then compares each with its
        group's first, character by character; an odd one stands alone."""
        lengths = tokens.lengths
        picked = np.flatnonzero(lengths > 1)
        starts, sizes = tokens.first[picked], lengths[picked]
        n = len(picked)
        if not n:
            return Distinct(picked, picked, starts, sizes, np.zeros(0, dtype=np.uint64))
        keys = A.Prefix(self.codes[self.char[tokens.points]]).spans(starts, starts + sizes)
        bits = np.uint64(max(1, int(n - 1).bit_length()))
        packed = np.sort((keys >> bits << bits) | np.arange(n, dtype=np.uint64))
        order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.ones(n, dtype=bool)
        new[1:] = (packed[1:] >> bits) != (packed[:-1] >> bits)
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        same = sizes[order] == sizes[head]
        each = np.where(same, sizes[order], 0)
        step = A.expanded(each)
        equal = tokens.points[np.repeat(starts[order], each) + step] == tokens.points[np.repeat(starts[head], each) + step]
        same &= A.summed(~equal, np.concatenate([[0], np.cumsum(each)])) == 0
        new |= ~same
        which = np.empty(n, dtype=np.int64)
        # rows of a group after an odd one belong to the group's number
        number = np.cumsum(new) - 1
        at = np.empty(n, dtype=np.int64)
        at[order] = np.arange(n)
        which[order] = np.where(new, number, number[at[head]])
        return Distinct(picked, which, starts[order[new]], sizes[order[new]], keys[order[new]])

    def utf8_lengths(self, points: np.ndarray) -> np.ndarray:
        return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)

    def single_counts(self, points: np.ndarray) -> np.ndarray:
        """Tokens of characters that stand alone."""
        known = self.single[points] >= 0
        return np.where(known, 1, self.utf8_lengths(points) if self.byte_fallback else 1)


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name))
