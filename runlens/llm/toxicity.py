"""Toxicity by maximum-scoring segments of token log-odds.

Learning, from labelled rows outside the held-out fold:

1. toxic and clean texts that hold a token are counted, equal texts once, so
   that a text which repeats a word doesn't count for more;
2. each token's log-odds ratio takes an informative Dirichlet prior (the
   token's share of all such counts, `prior` of all counts together), and
   tokens whose ratio isn't `least_z` standard errors from 0 are dropped, so
   rare words don't count;
3. a token scores its log-odds less `drift`, any other token -drift: the mean
   is negative in clean text, as the theory of maximal segments needs.  Its
   scale lambda is the root of sum p exp(lambda s) = 1 over clean tokens, and
   K is fitted to the best segments of clean training texts.

Scoring: one linear pass over a text finds all maximal scoring segments.  A
segment of score S is significant if K n exp(-lambda S), the number expected
in n clean tokens, is below `expected`.  The segments together have the
p-value of a sum of r normalised scores, for the r that makes it least; its
negative logarithm goes through a logistic curve fitted to training texts.

At most `rows` labelled rows (chosen by a hash of their id) and `tokens`
tokens make the model, so what reaches the driver and the tasks is bounded.
Only texts are inputs of a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.tables import id_and_text, map_batches, written

FOLDS = 5
EULER = 0.5772156649015329

# Letters, digits and all bytes of other scripts are kept, in lower case.
TOKEN_BYTE = np.full(256, 0x20, dtype=np.uint8)
TOKEN_BYTE[48:58] = np.arange(48, 58)
TOKEN_BYTE[97:123] = TOKEN_BYTE[65:91] = np.arange(97, 123)
TOKEN_BYTE[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Learning:
    rows: int = 20_000
    tokens: int = 20_000
    prior: float = 0.05
    least_z: float = 3.0
    drift: float = 0.5
    expected: float = 0.05


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted hashes of tokens
    scores: np.ndarray
    drift: float
    scale: float  # lambda
    log_k: float
    expected: float
    base: float = 0.0  # of the logistic curve
    slope: float = 1.0

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * np.log1p(evidence), -30, 30)))


def tokens(column: pa.Array) -> tuple[A.Words, np.ndarray]:
    data, offsets = A.texts(column)
    data = TOKEN_BYTE[data]
    w = A.words(data, offsets)
    return w, A.word_hashes(data, w)


def maximal_segments(scores: list[float], places: list[int], gap: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first place, last place) of a
    sequence whose places not listed score -gap; linear in the list."""
    found: list[list[float]] = []  # [sum before, sum after, first, last], the candidates
    total, last = 0.0, -1
    for score, place in zip(scores, places, strict=True):
        total -= gap * (place - last - 1)
        last = place
        before, total = total, total + score
        if score <= 0:
            continue
        now = [before, total, place, place]
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= now[0]:
                j -= 1
            if j < 0 or found[j][1] >= now[1]:
                break
            now = [found[j][0], now[1], found[j][2], now[3]]
            del found[j:]
        found.append(now)
    return [(x[1] - x[0], int(x[2]), int(x[3])) for x in found]


def _evidence(segments: list[tuple[float, int, int]], n: int, model: Model) -> tuple[float, list[tuple[float, int, int]]]:
    """-log p of the significant segments together, and these segments."""
    floor = model.log_k + math.log(max(n, 1))
    normal = sorted(((model.scale * s[0] - floor, s) for s in segments), reverse=True)
    good = [x for x in normal if x[0] > -math.log(model.expected)]
    best = total = 0.0
    for r, (x, _) in enumerate(good, 1):
        total += x
        best = max(best, total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r))
    return best, [x[1] for x in good]


def scored(column: pa.Array, model: Model) -> list[tuple[float, list[tuple[float, int, int]], float, int]]:
    """(evidence, significant segments, best segment's score, tokens) of each text."""
    w, hashes = tokens(column)
    at = np.minimum(np.searchsorted(model.keys, hashes), max(0, len(model.keys) - 1))
    known = np.flatnonzero(model.keys[at] == hashes) if len(model.keys) else np.zeros(0, dtype=np.int64)
    score = model.scores[at[known]] if len(known) else np.zeros(0)
    first = np.searchsorted(known, w.first)
    out = []
    for i, n in enumerate(w.counts.tolist()):
        a, b = first[i], first[i + 1]
        if not (score[a:b] > 0).any():
            out.append((0.0, [], 0.0, n))
            continue
        segments = maximal_segments(score[a:b].tolist(), (known[a:b] - w.first[i]).tolist(), model.drift)
        evidence, good = _evidence(segments, n, model)
        out.append((evidence, good, max(s[0] for s in segments), n))
    return out


def held_out(doc_id: Column) -> Column:
    """Fold 0 of the id's crc32; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _training(docs: DataFrame, labels: DataFrame, how: Learning) -> DataFrame:
    """(text, toxic) of at most about `rows` labelled rows of other folds."""
    own = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = own.count()
    if n > how.rows:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * how.rows / n))
    # no more than about `rows` rows of 12 bytes
    return docs.join(F.broadcast(own), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def _token_counts(training: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                w, hashes = tokens(part.column(0))
                own = np.arange(part.num_rows).repeat(w.counts)
                _, once = np.unique(A.mixed(hashes + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                hashes, toxic = hashes[once], part.column(1).to_numpy()[own[once]]
                key, which = np.unique(hashes, return_inverse=True)
                total, bad = np.bincount(which, minlength=len(key)), np.bincount(which, weights=toxic, minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(bad), pa.array(total - bad)], names=["token", "toxic", "clean"])

    return map_batches(training, rows, "token long, toxic long, clean long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _scale(scores: np.ndarray, counts: np.ndarray, rest: float, drift: float) -> float:
    """The positive root of the mean of exp(scale * score) less 1."""
    weights = np.append(counts, rest) / (counts.sum() + rest)
    values = np.append(scores, -drift)
    low, high = 0.0, 1.0
    mean = lambda x: float((weights * np.exp(np.clip(x * values, -700, 700))).sum())
    while mean(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Base and slope by Newton steps, with a slight ridge."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.array([-2.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-3 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 1e-6))


def learn(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> Model:
    """The model of (doc_id, text) documents and (doc_id, toxic) labels.  With
    no label of one of the kinds, every text scores the same."""
    training = written(_training(docs, labels, how), "toxicity-training")
    counts = written(_token_counts(training), "toxicity-counts")
    n_toxic, n_clean = (float(x or 0) for x in counts.agg(F.sum("toxic"), F.sum("clean")).first())
    share = training.agg(F.avg("toxic")).first()[0]
    if not n_toxic or not n_clean:
        constant = min(max(share or 0.0, 0.01), 0.99)
        return Model(np.zeros(0, np.uint64), np.zeros(0), how.drift, 1.0, 0.0, how.expected, math.log(constant / (1 - constant)), 1.0)
    prior = F.lit(how.prior) * (F.col("toxic") + F.col("clean"))
    everything = how.prior * (n_toxic + n_clean)
    bad, good = F.col("toxic") + prior, F.col("clean") + prior
    ratio = F.log(bad / (n_toxic + everything - bad)) - F.log(good / (n_clean + everything - good))
    judged = counts.select("token", "clean", ratio.alias("ratio"), (ratio / F.sqrt(1 / bad + 1 / good)).alias("z"))
    kept = judged.where(F.abs("z") >= how.least_z).orderBy(F.abs("z").desc(), "token").limit(how.tokens).toPandas()
    keys = kept["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    scores = kept["ratio"].to_numpy(dtype=float)[order] - how.drift
    clean = kept["clean"].to_numpy(dtype=float)[order]
    model = Model(keys[order], scores, how.drift, _scale(scores, clean, max(n_clean - clean.sum(), 1.0), how.drift), 0.0, how.expected)

    def judge(of: Model) -> tuple[np.ndarray, ...]:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in A.chunks(batch):
                    found = scored(part.column(0), of)
                    yield pa.RecordBatch.from_arrays([part.column(1), pa.array([x[0] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.float64()), pa.array([x[3] for x in found], pa.int64())], names=["toxic", "evidence", "best", "n"])

        # a row of numbers for each training text, whose number is bounded
        found = map_batches(training, rows, "toxic int, evidence double, best double, n long").toPandas()
        return tuple(found[c].to_numpy(dtype=float) for c in ("toxic", "evidence", "best", "n"))

    toxic, _, best, n = judge(model)
    null = (toxic == 0) & (best > 0)
    if null.any():
        # best segments of clean texts: scale * S - log n has the mean log K + Euler's constant
        rate = null.sum() / max(1, (toxic == 0).sum())
        excess = model.scale * best[null] - np.log(np.maximum(n[null], 1))
        model = Model(**{**model.__dict__, "log_k": float(np.median(excess)) - EULER + math.log(rate)})
    toxic, evidence, _, _ = judge(model)
    base, slope = _logistic(np.log1p(evidence), toxic)
    return Model(**{**model.__dict__, "base": base, "slope": slope})


def toxicity(docs: DataFrame, labels: DataFrame, how: Learning = Learning(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and passages (first
    token-last token:score) for each row of docs.  A null or empty text has no
    passage and the score of such texts."""
    docs = id_and_text(docs, id_col, text_col)
    model = learn(docs, labels, how)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                found = scored(part.column(2), model)
                score = model.probability(np.array([x[0] for x in found]))
                told = [",".join(f"{a}-{b}:{s:.2f}" for s, a, b in sorted(x[1], key=lambda y: y[1])) for x in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([len(x[1]) for x in found], pa.int64()), pa.array(told, pa.string())], names=["doc_id", "held_out", "score", "predicted", "n_passages", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), rows, f"doc_id {kind}, held_out boolean, score double, predicted int, n_passages long, passages string")
