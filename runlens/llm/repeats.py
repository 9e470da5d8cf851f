"""Which windows of a corpus occur twice: the plan that two operators share.

A window is `length` units (bytes or words) of one text.  Its anchor is the
smallest hash of the k-grams in it, the leftmost of equals; equal windows have
equal anchors at equal distances, so windows are compared only within the
bucket of an anchor, and anchors that occur once end the search early:

1. each text gives its anchors, one for some length / 2 units;
2. anchors that occur at two places or more are found by partial counts;
3. texts that hold such anchors are kept once each, with those places;
4. each of the places sends the stretch of windows that it anchors to the
   bucket of the anchor, where the operator's method marks repeated windows;
5. marked stretches go back to their texts.

Anchors with more than `HOT` places (a passage that a large share of all
documents hold) are not gathered in a bucket: their windows are compared by
hash where they lie, then one of each hash goes on, an exact way of any size.  Texts that occur more
than once are handled once, and are repeats as a whole.  Texts, anchors and
hot windows are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.tables import id_and_text, map_batches, written

# Places of one anchor that are gathered in one task at most.
HOT = 4096
# Bytes of stretches that are compared at a time; a bucket isn't cut.
BLOCK_BYTES = 2 << 20
# Hot windows that are compared where they lie, and the groups that they are
# sent in for each shuffle partition.
ENTRIES = 1 << 20
GROUPS = 4
# Texts that a task remembers to have given.
GIVEN = 1 << 20
POSITION_BITS = np.uint64(31)  # a Spark string has fewer bytes


@dataclass
class Anchors:
    """Anchors of a batch of texts, in their order."""

    text: np.ndarray  # the text's number
    at: np.ndarray  # unit where the anchor begins
    key: np.ndarray  # its hash
    begin: np.ndarray  # first window that it anchors
    end: np.ndarray  # after the last


def window_anchors(grams: np.ndarray, width: int, begins: np.ndarray, text_of: np.ndarray, text_begin: np.ndarray) -> Anchors:
    """Anchors of the windows that begin at `begins` (in units of the batch)
    and hold `width` grams each."""
    if not len(begins):
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none, none.astype(np.uint64), none, none)
    low = (grams >> POSITION_BITS << POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    at = (low[begins] & ((np.uint64(1) << POSITION_BITS) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(begins), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(new)
    text = text_of[first]
    begin = begins[first]
    size = np.diff(np.append(first, len(begins)))
    base = text_begin[text]
    return Anchors(text, at[first] - base, grams[at[first]], begin - base, begin - base + size)


class Method(ABC):
    length: int  # units of a window

    @abstractmethod
    def sizes(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Units of each text."""

    @abstractmethod
    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Anchors]:
        """Units of each text, and the anchors of all."""

    @abstractmethod
    def stretches(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> list[bytes]:
        """What the bucket needs of each anchor's windows."""

    @abstractmethod
    def window_keys(self, data: np.ndarray, offsets: np.ndarray, found: Anchors) -> np.ndarray:
        """A hash of each window of the anchors, one after the other."""

    @abstractmethod
    def repeated(self, bucket: np.ndarray, lead: np.ndarray, sizes: np.ndarray, stretches: list[bytes]) -> np.ndarray:
        """Which windows occur twice in their bucket: rows have a bucket, the
        anchor's distance from the first window, a number of windows and the
        stretch; the mask runs over all windows of all rows."""

    @abstractmethod
    def kept(self, text: bytes, covered: np.ndarray | None) -> bytes:
        """What is left of a text without its covered units."""


def _digest_rows(docs: DataFrame, method: Method) -> DataFrame:
    """doc_id, tid, n units, digest of the whole, packed (anchor, at) pairs
    (null where the task has given the text's before)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in A.chunks(batch):
                data, offsets = A.texts(part.column(2))
                n, found = method.anchors(data, offsets)
                first = np.searchsorted(found.text, np.arange(len(n) + 1))
                both = np.stack([found.key.view(np.int64), found.at], axis=1)
                raw = data.tobytes()
                packed, whole = [], []
                for i, tid in enumerate(part.column(1).to_pylist()):
                    whole.append(hashlib.sha256(method.kept(raw[offsets[i] : offsets[i + 1]], None)).hexdigest())
                    packed.append(None if tid in given else both[first[i] : first[i + 1]].tobytes())
                    given.add(tid)
                if len(given) > GIVEN:
                    given.clear()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(whole), pa.array(packed, pa.binary())], names=["doc_id", "tid", "n", "whole", "packed"])

    return map_batches(docs.select("doc_id", F.xxhash64("text"), "text"), rows, f"doc_id {kind}, tid long, n long, whole string, packed binary")


def _places(rows: DataFrame) -> DataFrame:
    """(anchor, tid, at) of every text's anchors."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) // 16 for x in batch.column(1).to_pylist()], dtype=np.int64)
            both = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64).reshape(-1, 2)
            tid = np.repeat(batch.column(0).to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(tid), pa.array(both[:, 1].astype(np.int32))], names=["anchor", "tid", "at"])

    return map_batches(rows.where("length(packed) > 0").select("tid", "packed"), unpack, "anchor long, tid long, at int")


def _shared_texts(docs: DataFrame, rows: DataFrame, hot: int) -> DataFrame:
    """(tid, text, places): each text that holds a repeated anchor, once, with
    the anchor's places as 2 * at, or 2 * at + 1 for a hot one."""
    places = _places(rows)
    place = F.xxhash64("tid", "at")
    twice = places.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("n")).where("low != high")
    # written, so that both sides of the join come from shuffles of their own
    # and Spark can split the partition of a hot anchor
    twice = written(twice.select("anchor", (F.col("n") > hot).cast("int").alias("hot")), "repeat-anchors")
    found = places.join(twice, "anchor")
    of_text = found.groupBy("tid").agg(F.collect_set((2 * F.col("at").cast("long") + F.col("hot"))).alias("places"))
    once = docs.select(F.xxhash64("text").alias("tid"), "text").groupBy("tid").agg(F.first("text").alias("text"))
    return once.join(of_text, "tid")


def _picked(part: pa.RecordBatch, method: Method, hot: bool) -> tuple[np.ndarray, np.ndarray, Anchors]:
    """The anchors of (tid, text, places) rows that are among the places."""
    data, offsets = A.texts(part.column(1))
    _, found = method.anchors(data, offsets)
    lists = part.column(2)
    wanted = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    mine = (wanted & 1) == hot
    keys = np.sort(owner[mine] << np.int64(32) | (wanted[mine] >> 1))
    have = found.text << np.int64(32) | found.at
    at = np.minimum(np.searchsorted(keys, have), max(0, len(keys) - 1))
    keep = keys[at] == have if len(keys) else np.zeros(len(have), dtype=bool)
    return data, offsets, Anchors(found.text[keep], found.at[keep], found.key[keep], found.begin[keep], found.end[keep])


def _runs(tid: np.ndarray, begin: np.ndarray, sizes: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    """Stretches of marked windows as (tid, begin, end)."""
    first = np.cumsum(sizes) - sizes
    edge = np.zeros(len(mask) + 1, dtype=bool)
    edge[first[sizes > 0]] = True
    edge[-1] = True
    starts = mask & (np.concatenate([[True], ~mask[:-1]]) | edge[:-1]) if len(mask) else mask
    stops = mask & (np.concatenate([~mask[1:], [True]]) | edge[1:]) if len(mask) else mask
    a, b = np.flatnonzero(starts), np.flatnonzero(stops)
    row = np.searchsorted(first, a, side="right") - 1
    # rows without windows share a first with the next
    return pa.RecordBatch.from_arrays([pa.array(tid[row]), pa.array(begin[row] + a - first[row]), pa.array(begin[row] + b - first[row] + 1)], names=["tid", "begin", "end"])


def _marked(shared: DataFrame, method: Method) -> DataFrame:
    """(tid, begin, end): stretches of window starts that are repeated."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                data, offsets, found = _picked(part, method, False)
                tid = part.column(0).to_numpy()[found.text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.key.view(np.int64)), pa.array(tid), pa.array(found.begin), pa.array((found.end - found.begin).astype(np.int32)), pa.array((found.at - found.begin).astype(np.int32)), pa.array(method.stretches(data, offsets, found), pa.binary())],
                    names=["anchor", "tid", "begin", "size", "lead", "stretch"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                column = {name: t.column(name) for name in t.column_names}
                sizes = column["size"].to_numpy().astype(np.int64)
                mask = method.repeated(column["anchor"].to_numpy(), column["lead"].to_numpy().astype(np.int64), sizes, column["stretch"].to_pylist())
                yield _runs(column["tid"].to_numpy(), column["begin"].to_numpy(), sizes, mask)

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            if not len(anchor):
                continue
            weight = np.cumsum([len(x) for x in batch.column(5).to_pylist()])
            ends = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], False)) + 1  # buckets that end in this batch
            if held and held[-1].column(0)[-1].as_py() != anchor[0]:
                ends = np.append(0, ends)
            at = 0
            for end in ends.tolist():
                size = int(weight[end - 1] - (weight[at - 1] if at else 0)) if end else 0
                if n + size >= BLOCK_BYTES or not end:
                    if end:
                        held.append(batch.slice(at, end - at))
                        at = end
                    if n + size >= BLOCK_BYTES:
                        yield from done(held)
                        held, n = [], 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
                n += int(weight[-1] - (weight[at - 1] if at else 0))
        yield from done(held)

    sent = map_batches(shared, send, "anchor long, tid long, begin long, size int, lead int, stretch binary")
    met = map_batches(sent.repartition("anchor").sortWithinPartitions("anchor"), meet, "tid long, begin long, end long")
    return met.union(_marked_hot(shared, method))


def _starts(tid: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """(tid, begin, end) of the runs of single window starts."""
    order = np.lexsort((begin, tid))
    tid, begin = tid[order], begin[order]
    new = np.ones(len(tid), dtype=bool)
    new[1:] = (tid[1:] != tid[:-1]) | (begin[1:] != begin[:-1] + 1)
    last = np.append(new[1:], True) if len(new) else new
    return np.stack([tid[new], begin[new], begin[last] + 1], axis=1)


def _marked_hot(shared: DataFrame, method: Method) -> DataFrame:
    """The same for windows of hot anchors, of any number.  Where texts lie,
    windows with the same hash are marked and one of them is sent; where the
    hashes meet, those that were alone are marked if others have come.  So a
    window sends one entry from each block of a task, however many hold it."""
    groups = GROUPS * int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(out: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["group", "kind", "packed"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def sent() -> pa.RecordBatch:
            entries = np.concatenate(held)
            entries = entries[np.argsort(entries[:, 0], kind="stable")]
            new = np.ones(len(entries), dtype=bool)
            new[1:] = entries[1:, 0] != entries[:-1, 0]
            many = np.diff(np.append(np.flatnonzero(new), len(entries))) > 1
            marked = many[np.cumsum(new) - 1]
            first = entries[new]
            first[:, 3] = many
            group = (first[:, 0].view(np.uint64) % np.uint64(groups)).astype(np.int64)
            first = first[np.argsort(group, kind="stable")]
            at = np.searchsorted(np.sort(group), np.arange(groups + 1))
            out = [(int(g), 0, first[at[g] : at[g + 1]].tobytes()) for g in np.flatnonzero(np.diff(at))]
            if marked.any():
                out.append((int(group[0]), 1, _starts(entries[marked, 1], entries[marked, 2]).tobytes()))
            return packed(out)

        for batch in batches:
            for part in A.chunks(batch):
                data, offsets, found = _picked(part, method, True)
                sizes = found.end - found.begin
                tid = np.repeat(part.column(0).to_numpy()[found.text], sizes)
                begin = np.repeat(found.begin, sizes) + A.expanded(sizes)
                held.append(np.stack([method.window_keys(data, offsets, found).view(np.int64), tid, begin, np.zeros(len(tid), dtype=np.int64)], axis=1))
                n += len(tid)
                if n >= ENTRIES:
                    yield sent()
                    held, n = [], 0
        if n:
            yield sent()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(runs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(runs[:, i])) for i in range(3)], names=["tid", "begin", "end"])

        def done(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if held:
                entries = np.concatenate(held)
                new = entries[A.repeated(entries[:, 0].view(np.uint64)) & (entries[:, 3] == 0)]
                yield told(_starts(new[:, 1], new[:, 2]))

        now, held = None, []
        for batch in batches:
            for group, kind, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != now:
                    yield from done(held)
                    now, held = group, []
                values = np.frombuffer(raw, dtype=np.int64)
                if kind:
                    yield told(values.reshape(-1, 3))
                else:
                    held.append(values.reshape(-1, 4))
        yield from done(held)

    sent = map_batches(shared.where("exists(places, x -> x % 2 = 1)"), send, "group int, kind int, packed binary")
    return map_batches(sent.repartition("group").sortWithinPartitions("group"), meet, "tid long, begin long, end long")


def _cleaned(shared: DataFrame, marked: DataFrame, method: Method) -> DataFrame:
    """(tid, n_removed, n_spans, kept_sha256) of texts with marked windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                data, offsets = A.texts(part.column(1))
                n = method.sizes(data, offsets)
                raw = data.tobytes()
                out = []
                for i, (begins, ends) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    steps = np.zeros(n[i] + 1, dtype=np.int32)
                    np.add.at(steps, begins, 1)
                    np.add.at(steps, np.array(ends) - 1 + method.length, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    out.append((int(gone.sum()), spans, hashlib.sha256(method.kept(raw[offsets[i] : offsets[i + 1]], gone)).hexdigest()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["tid", "n_removed", "n_spans", "kept_sha256"])

    runs = marked.groupBy("tid").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    joined = shared.select("tid", "text").join(runs, "tid").select("tid", "text", "runs.begin", "runs.end")
    return map_batches(joined, rows, "tid long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, method: Method, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n (units), n_removed, n_spans and
    kept_sha256 (of what is left without units that lie in a repeated window).

    A null or empty text has no unit and the digest of no bytes.  Each copy of
    a text is a place of its own, repeated rows and rows without id included.
    """
    docs = id_and_text(docs, id_col, text_col)
    rows = written(_digest_rows(docs, method), "repeat-rows")
    shared = written(_shared_texts(docs, rows, hot), "repeat-texts")
    marked = _marked(shared, method)
    cleaned = _cleaned(shared, marked, method)
    copies = rows.groupBy("tid").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    cleaned = cleaned.join(copies, "tid", "full_outer")
    out = rows.drop("packed").join(cleaned, "tid", "left")
    gone = (F.col("copies") > 1) & (F.col("n") >= method.length)
    return out.select(
        "doc_id",
        "n",
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
