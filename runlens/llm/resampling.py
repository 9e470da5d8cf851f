"""Importance resampling towards a target: hashed n-gram features, Gumbel top-k.

Words of the corpus and of the target fall into buckets by CRC-32.  A bucket's
gain is the log ratio of its smoothed frequencies, a document's weight the sum
of the gains of its features.  With Gumbel noise on the weights, the documents
of the highest scores are a sample without replacement whose odds follow the
weights.

Texts are scored as arrays: the CRCs of all words of a batch advance together,
byte by byte.  Only one row of numbers per document is then ranked, by the
radix sort of `radix`.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.radix import ranked
from runlens.llm.tables import id_and_text, map_batches, written

# Bytes of one text that are worked on at a time.
PART_BYTES = 1 << 20
# Spans longer than this get their CRC one by one.
LONG_SPAN = 64
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


@dataclass(frozen=True)
class Resampling:
    """Features are runs of 1 to `most_words` words; `percent` of the
    documents with `least_words` words or more are drawn."""

    most_words: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


def _plain() -> np.ndarray:
    """Bytes of words with A-Z lower-cased, all others as spaces."""
    table = np.full(256, 0x20, dtype=np.uint8)
    for b in range(256):
        if WORD.match(bytes([b])):
            table[b] = b | 0x20 if 0x41 <= b <= 0x5A else b
    return table


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


PLAIN, CRC = _plain(), _crc_table()


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, all spans a byte at a time."""
    sizes = ends - starts
    out = np.empty(len(sizes), dtype=np.uint32)
    long = sizes > LONG_SPAN
    out[long] = [zlib.crc32(data[a:b]) for a, b in zip(starts[long], ends[long], strict=True)]
    short = np.flatnonzero(~long)
    short = short[np.argsort(sizes[short].astype(np.uint8), kind="stable")[::-1]]  # the longest first
    at, size = starts[short], sizes[short]
    state = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(int(size[0]) if len(size) else 0):
        m = int(np.searchsorted(-size, -i, side="left"))  # spans that have a byte i
        state[:m] = CRC[(state[:m] ^ data[at[:m] + i]) & 0xFF] ^ (state[:m] >> np.uint32(8))
    out[short] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _buckets(raw: np.ndarray, offsets: np.ndarray, rules: Resampling, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of each feature that starts before byte `limit`, and the
    words of each text."""
    data = PLAIN[raw]
    word = data != 0x20
    keep = word.copy()  # one space after each word
    keep[1:] |= word[:-1]
    data, offsets = data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
    w = A.words(data, offsets)
    stop = len(w.starts) if limit is None else int(np.searchsorted(w.starts, int(np.count_nonzero(keep[:limit]))))
    text_of = w.text_of
    texts, found = [], []
    for k in range(1, rules.most_words + 1):
        first = w.windows(k) if k > 1 else np.arange(len(w.starts))
        first = first[first < stop]
        texts.append(text_of[first])
        found.append(crc32_of(data, w.starts[first], w.ends[first + k - 1]) % np.uint32(rules.buckets))
    return np.concatenate(texts), np.concatenate(found).astype(np.int64), np.bincount(text_of[:stop], minlength=len(offsets) - 1)


def features(column: pa.Array, rules: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bucket) of all features of a column and the words of each text,
    in parts; a long text is cut between words."""
    raw, offsets = A.texts(column)
    begin = 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PART_BYTES, side="right")) - 1)
        data, at = raw[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        if len(data) <= PART_BYTES:
            texts, found, words = _buckets(data, at, rules)
            all_words = np.zeros(len(offsets) - 1, dtype=np.int64)
            all_words[begin:end] = words
            yield texts + begin, found, all_words
        else:
            text, low = data.tobytes(), 0
            while low < len(text):
                cut = GAP.search(text, low + PART_BYTES)
                high = far = cut.start() if cut else len(text)
                for _ in range(rules.most_words - 1):  # words that features go on into
                    more = WORD.search(text, far)
                    far = more.end() if more else len(text)
                texts, found, words = _buckets(data[low:far], np.array([0, far - low]), rules, high - low)
                all_words = np.zeros(len(offsets) - 1, dtype=np.int64)
                all_words[begin] = words[0]
                yield texts + begin, found, all_words
                low = high
        begin = end


def bucket_counts(docs: DataFrame, rules: Resampling, text_col: str = "text") -> np.ndarray:
    """Features in each bucket, over all rows; a task adds up its own rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rules.buckets, dtype=np.int64)
        for batch in batches:
            for part in A.chunks(batch):
                for _, found, _ in features(part.column(0), rules):
                    total += np.bincount(found, minlength=rules.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    out = np.zeros(rules.buckets, dtype=np.int64)
    for bucket, n in map_batches(texts, counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # a row for each bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray, rules: Resampling) -> np.ndarray:
    """Each bucket's log ratio of smoothed frequencies, in thousandths."""
    s_all, t_all = float(corpus.sum() + rules.buckets), float(target.sum() + rules.buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise from the hash of seed and id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _measured(ids: pa.Array, column: pa.Array, gain: np.ndarray, rules: Resampling) -> dict[str, np.ndarray]:
    n = len(column)
    n_features, weight, n_words = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for texts, found, words in features(column, rules):
        n_features += np.bincount(texts, minlength=n)
        weight += np.bincount(texts, weights=gain[found], minlength=n).astype(np.int64)  # exact below 2**53
        n_words += words
    score = weight + np.fromiter((noise(i, rules.seed) for i in ids.to_pylist()), np.int64, n)
    return {"n_features": n_features, "weight": weight, "score": score, "n_words": n_words}


def learned(docs: DataFrame, target: DataFrame, rules: Resampling, text_col: str = "text") -> np.ndarray:
    return gains(bucket_counts(docs, rules, text_col), bucket_counts(target, rules, text_col), rules)


def scored(docs: DataFrame, gain: np.ndarray, rules: Resampling, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and n_words of each row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                found = _measured(part.column(0), part.column(1), gain, rules)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, found.values())], names=["doc_id", *found])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_text(docs, id_col, text_col), rows, f"doc_id {kind}, n_features long, weight long, score long, n_words long")


def _places(docs: DataFrame, gain: np.ndarray, rules: Resampling, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """`scored` with the rank of documents long enough, and how many are drawn."""
    all_rows = written(scored(docs, gain, rules, id_col, text_col), "weights")
    long = F.col("n_words") >= rules.least_words
    drawn = rules.percent * all_rows.filter(long).count() // 100
    # ~x is -x - 1: the highest score comes first
    order = all_rows.filter(long).withColumn("__falling", F.bitwise_not("score"))
    return ranked(order, ["__falling", "doc_id"]).drop("__falling").unionByName(all_rows.filter(~long).withColumn("rank", F.lit(None).cast("long"))), drawn


def resampling_report(docs: DataFrame, target: DataFrame, rules: Resampling = Resampling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of each row of docs; rank is
    null for those that aren't drawn.

    A null or empty text has no features and weight 0; a null id counts as an
    empty one for the noise, and comes last among equal scores; repeated rows
    are ranked one by one, in no fixed order; without a target all gains are
    those of zero counts; no rows give none.  Ids are integers; other columns
    aren't read.
    """
    places, drawn = _places(docs, learned(docs, target, rules, text_col), rules, id_col, text_col)
    return places.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, rules: Resampling = Resampling(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows of docs, all columns.  Cases as in `resampling_report`;
    rows that tie in score and id with the last one drawn are all drawn."""
    gain = learned(docs, target, rules, text_col)
    places, drawn = _places(docs, gain, rules, id_col, text_col)
    last = places.filter(F.col("rank") == drawn).select("score", "doc_id").first()
    if last is None:
        return docs.limit(0)
    least, id_ = last["score"], math.inf if last["doc_id"] is None else last["doc_id"]
    at = docs.columns.index(id_col), docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch, text_col):
                found = _measured(part.column(at[0]), part.column(at[1]), gain, rules)
                first = np.array([math.inf if i is None else i for i in part.column(at[0]).to_pylist()], dtype=object) <= id_
                score = found["score"]
                yield part.filter(pa.array((found["n_words"] >= rules.least_words) & ((score > least) | ((score == least) & first.astype(bool)))))

    return map_batches(docs, rows, docs.schema)


def duck_sql(rules: Resampling = Resampling()) -> str:
    """The rows of `resampling_report` for features of one word, in DuckDB."""
    if rules.most_words != 1:
        raise ValueError("the SQL has features of one word")
    b = rules.buckets
    words = lambda table, key: f"SELECT {key} AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM {table}"
    return f"""
        WITH RECURSIVE crc_step(i, c, k) AS (
            SELECT i, i::BIGINT, 0 FROM range(256) r(i)
            UNION ALL
            SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_step WHERE k < 8
        ), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8),
        doc_words AS ({words("documents", "doc_id")}),
        item_words AS ({words("benchmark", "item_id")}),
        vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION ALL SELECT word FROM item_words)),
        word_crc(word, h, i, c) AS (
            SELECT word, h, 1, 4294967295::BIGINT FROM vocabulary
            UNION ALL
            SELECT word, h, i + 2, xor(c // 256, t[1 + xor(c % 256, ('0x' || h[i : i + 1])::BIGINT)]) FROM word_crc, crc_table WHERE i < length(h)
        ),
        bucket_of AS (SELECT word, xor(c, 4294967295) % {b} AS bucket FROM word_crc WHERE i > length(h)),
        corpus AS (SELECT bucket, count(*) AS s FROM doc_words JOIN bucket_of USING (word) GROUP BY bucket),
        target AS (SELECT bucket, count(*) AS t FROM item_words JOIN bucket_of USING (word) GROUP BY bucket),
        total AS (SELECT (SELECT count(*) FROM doc_words)::DOUBLE + {b} AS s_all, (SELECT count(*) FROM item_words)::DOUBLE + {b} AS t_all),
        gain AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all / ((s + 1)::DOUBLE * t_all)))::BIGINT AS gain
            FROM corpus LEFT JOIN target USING (bucket), total
        ),
        weighed AS (
            SELECT id, count(*) AS n, sum(gain)::BIGINT AS weight FROM doc_words JOIN bucket_of USING (word) JOIN gain USING (bucket) GROUP BY id
        ),
        noisy AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                floor(-1000 * ln(-ln((('0x' || sha256('{rules.seed}:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
            FROM documents LEFT JOIN weighed ON id = doc_id
        ),
        ordered AS (
            SELECT *, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER () AS n FROM noisy WHERE n_features >= {rules.least_words}
        )
        SELECT d.doc_id, d.n_features, d.weight, d.weight + d.noise AS score,
            CASE WHEN o.place <= {rules.percent} * o.n // 100 THEN o.place END AS rank
        FROM noisy d LEFT JOIN ordered o USING (doc_id)"""
