"""Quality rules: counts of words and lines, and compression bands.

A text is rejected if the base rules fail, or if its zstandard ratio
(compressed / plain bytes) leaves the band for its length: below it the text
repeats itself, above it it looks random.  The same holds for each fixed chunk
of a text, so that a long text can't hide such a passage.

Limits grow tighter with the length since short texts compress worse.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from runlens.llm import arrays as A
from runlens.llm.tables import id_and_text, map_batches

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Bands:
    """Ratio limits by length in bytes: (shortest text, least, most)."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0),
        (128, 0.50, 1.00),
        (256, 0.48, 0.90),
        (512, 0.46, 0.80),
        (1024, 0.425, 0.75),
        (2048, 0.41, 0.75),
        (4096, 0.385, 0.72),
        (16384, 0.36, 0.72),
        (65536, 0.33, 0.72),
    )
    chunk_bytes: int = 2048
    chunk_least_bytes: int = 512  # a shorter last chunk isn't judged
    chunk: tuple[float, float] = (0.40, 0.80)
    level: int = 3
    n_words: int = 20
    repeat_percent: int = 30
    repeat_window: int = 8


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean,"
    " ratio double, chunk_least double, chunk_most double"
)


def _dup_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\r\x0b\x0c"):
            seen.add(line)
    return n


def _ratios(data: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, float, float, bool]:
    """Ratio of the whole, least and most of the chunks, and the verdict."""
    n = len(data)
    if not n:
        return 1.0, 1.0, 1.0, True
    whole = len(packer.compress(data)) / n
    least, most = next((x[1], x[2]) for x in reversed(bands.whole) if n >= x[0])
    parts = [data[i : i + bands.chunk_bytes] for i in range(0, n, bands.chunk_bytes)]
    each = [len(packer.compress(x)) / len(x) for x in parts if len(x) >= bands.chunk_least_bytes] if n > bands.chunk_bytes else [whole]
    low, high = min(each), max(each)
    fine = least <= whole <= most
    if n >= bands.chunk_least_bytes:
        fine = fine and bands.chunk[0] <= low and high <= bands.chunk[1]
    return whole, low, high, fine


def measured(column: pa.Array, bands: Bands) -> dict[str, np.ndarray]:
    """The counts, ratios and verdicts of a column of texts."""
    data, offsets = A.texts(column)
    w = A.words(data, offsets)
    n_words = w.counts
    # a code point is a byte that continues none
    lead = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) & A.WORD_BYTE[data])])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
    k = bands.repeat_window
    begins = w.windows(k)
    n_repeat = np.zeros(len(n_words), dtype=np.int64)
    if len(begins):
        keys = A.Prefix(A.word_hashes(data, w)).grams(k)[begins]
        text_of = w.text_of
        twice = A.repeated(A.mixed(keys + text_of[begins].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        n_repeat = A.summed(A.covered(begins[twice], k, len(w.starts)), w.first)
    packer = zstandard.ZstdCompressor(level=bands.level)
    raw = data.tobytes()
    each = [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    ratios = [_ratios(x, bands, packer) for x in each]
    base_failed = (n_words < bands.n_words) | (100 * n_repeat > bands.repeat_percent * n_words)
    return {
        "n_words": n_words,
        "word_chars": lead[offsets[1:]] - lead[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.array([_dup_lines(x) for x in each], dtype=np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & np.array([x[3] for x in ratios], dtype=bool),
        "ratio": np.array([x[0] for x in ratios]),
        "chunk_least": np.array([x[1] for x in ratios]),
        "chunk_most": np.array([x[2] for x in ratios]),
    }


def quality_report(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs, with its counts and the verdict `kept`.

    A null or empty text has no words and fails; repeated rows and null ids
    get a row each; other columns aren't read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                found = measured(part.column(1), bands)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in found.values())], names=["doc_id", *found])

    return map_batches(id_and_text(docs, id_col, text_col), rows, SCHEMA.replace("doc_id long", f"doc_id {docs.schema[id_col].dataType.simpleString()}"))


def keep_good(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of docs whose text passes, with all their columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch, text_col):
                yield part.filter(pa.array(measured(part.column(part.schema.get_field_index(text_col)), bands)["kept"]))

    return map_batches(docs, rows, docs.schema)
