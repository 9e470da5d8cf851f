"""Substring dedup: seed and extend over winnowed anchors.

Seeds are word k-grams chosen by winnowing, so that every window of `length`
words holds one, chosen by the window's words alone.  Documents are joined on
seeds that occur at two places or more.  Each place extends its seed to both
sides: for every reach to the left it takes the rest of the window to the
right, and carries the hash of the words so covered.  A reach that another
place of the seed has with the same words is a repeat of the full length; the
union of such windows gives the maximal repeats over the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.repeats import HOT, Anchors, Method, window_anchors, without_repeats


@dataclass(frozen=True)
class SeedAndExtend(Method):
    length: int = 35
    seed: int = 5

    def _words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[A.Words, A.Prefix]:
        w = A.words(data, offsets)
        return w, A.Prefix(A.word_hashes(data, w))

    def sizes(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return A.words(data, offsets).counts

    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Anchors]:
        w, prefix = self._words(data, offsets)
        begins = w.windows(self.length)
        return w.counts, window_anchors(prefix.grams(self.seed), self.length - self.seed + 1, begins, w.text_of[begins], w.first[:-1])

    def window_keys(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> np.ndarray:
        """For each place, the words around its seed at every reach."""
        w, prefix = self._words(data, offsets)
        sizes = found.end - found.begin
        at = np.repeat(w.first[found.text] + found.begin, sizes) + A.expanded(sizes)
        return prefix.spans(at, at + self.length)

    def stretches(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> list[bytes]:
        keys = self.window_keys(data, offsets, found)
        ends = np.cumsum(found.end - found.begin).tolist()
        raw = keys.tobytes()
        return [raw[8 * a : 8 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []

    def repeated(self, bucket: np.ndarray, lead: np.ndarray, sizes: np.ndarray, stretches: list[bytes]) -> np.ndarray:
        reach = np.repeat(lead, sizes) - A.expanded(sizes)  # words to the left of the seed
        seed = np.repeat(bucket.view(np.uint64), sizes)
        keys = np.frombuffer(b"".join(stretches), dtype=np.uint64)
        return A.repeated(A.mixed(keys + A.mixed(seed + reach.astype(np.uint64))))

    def kept(self, text: bytes, covered: np.ndarray | None) -> bytes:
        words = text.split()
        return b" ".join(words if covered is None else [x for x, gone in zip(words, covered.tolist(), strict=True) if not gone])


def substring_dedup(docs: DataFrame, length: int = 35, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans for each row of docs:
    words outside all windows of `length` words that also start elsewhere.

    A null, empty or blank text has no words and the digest of no bytes.
    """
    found = without_repeats(docs, SeedAndExtend(length), hot, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256", "n_spans")
