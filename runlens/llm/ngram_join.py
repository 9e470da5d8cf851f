"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

A document is a row of the incidence matrix, its distinct word n-grams the
columns.  Equal rows are one class.  Which classes have a Jaccard similarity
of t or more is found by a product of the matrix with its transpose, in
blocks of columns:

- Two rows of a and b n-grams that reach t differ in at most
  H = (a + b) (1 - t) / (1 + t) columns.  So if the columns are dealt to H + 1
  blocks by hash, the rows agree on a whole block at least.  Sizes are cut in
  levels whose ends have the ratio t; a row is dealt at its own level and at
  the next one, with the H of the level's largest size, so that two rows
  whose sizes can reach t meet at a level.  A pair that shares no block is
  below the bound and never comes up, however frequent its n-grams are.
- Rows that agree on a block are tied by a tree, built where they lie and
  again after the shuffle: a block that a third of all rows share sends one
  row from each batch.  The overlap of each tied pair is counted from the n-grams
  of the two texts; pairs below the size-derived overlap are discarded.
- At lower thresholds blocks would be small, and small blocks agree by chance.
  There the keys are a row's rarest n-grams, by counters over all documents: as
  many that two rows which reach t must share one of them.  Passages that many
  documents share stay out of the keys of all but those made of them.
- Rows that are tied, but end in several components of links, are multiplied
  in full: sorted by component of ties (with rare keys: by key) and size, cut in blocks of rows, and
  each two blocks that share such a component and whose sizes can meet are
  multiplied column block by column block.  Counts accumulate in the product;
  only links leave it, so no link between different rows is lost and no pair
  is emitted in between.  With rare keys, pairs within reach leave it, which
  the rows' outlines (bitmaps of their hashes) bound again before they are
  counted.

Components of the links are taken over classes, then spread to documents.
Rows, n-grams and block contents are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import arrays as A
from runlens.llm.components import components
from runlens.llm.sharding import numbered
from runlens.llm.tables import id_and_text, map_batches, removed, settled, small_batches, written

# Entries that are tied at a time where they lie.
ENTRIES = 1 << 19
# Classes that a task remembers to have given keys of (else they go twice).
GIVEN = 1 << 17
# Blocks are shuffled in so many groups for each shuffle partition.
GROUPS = 4
# Blocks must hold so many n-grams on average; else rare n-grams are the keys.
BLOCK_NGRAMS = 8
# Counters of n-grams (4 bytes each): 2 ** SKETCH_BITS, sent in parts.
SKETCH_BITS, SKETCH_PARTS = 20, 64
# Bits of a row's outline.
OUTLINE_BITS = 1 << 13
# Rows and columns of the dense blocks that are multiplied.
BLOCK_ROWS = 256
BLOCK_COLUMNS = 4096


@dataclass(frozen=True)
class Similarity:
    n: int = 3  # words in an n-gram
    percent: int = 90  # of the union that two documents must share

    @property
    def in_blocks(self) -> bool:
        """Whether blocks hold enough n-grams to tell rows apart."""
        return (100 + self.percent) / (2 * (100 - self.percent)) >= BLOCK_NGRAMS if self.percent < 100 else True


@lru_cache(maxsize=8)
def _levels(percent: int, most: int) -> tuple[tuple[int, int], ...]:
    """(largest size, H) of each level up to the one after `most`."""
    out, low = [], 1
    while True:
        high = low * 100 // percent
        out.append((high, 2 * high * (100 - percent) // (100 + percent)))
        if low > most:
            return tuple(out)
        low = high + 1


def ngram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text, A-Z in lower case; a text
    of fewer words has its whole sequence as one, one without words none."""
    data, offsets = A.texts(column)
    data = A.LOWER[data]
    w = A.words(data, offsets)
    prefix = A.Prefix(A.word_hashes(data, w))
    begins = w.windows(n)
    grams = prefix.grams(n)[begins] if len(begins) else np.zeros(0, np.uint64)
    at = np.searchsorted(begins, w.first)
    few = prefix.spans(w.first[:-1], w.first[1:])
    counts = w.counts
    return [np.unique(grams[a:b]) if b > a else few[i : i + 1] if counts[i] else grams[:0] for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))]


def block_keys(row: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the row's blocks, at its level and the next."""
    size = len(row)
    levels = _levels(percent, 1 << (max(size, 2) - 1).bit_length())
    own = next(i for i, x in enumerate(levels) if size <= x[0])
    deal, content = A.mixed(row + np.uint64(0x51ED270B)), A.mixed(row ^ np.uint64(0x2545F4914F6CDD1D))
    out = []
    for level in (own, own + 1):
        differing = levels[level][1]
        if differing:
            sums = np.zeros(differing + 1, dtype=np.uint64)
            np.add.at(sums, (deal % np.uint64(differing + 1)).astype(np.int64), content)
            out.append(A.mixed(sums + np.arange(differing + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level << 40)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def rare_keys(row: np.ndarray, percent: int, counts: np.ndarray) -> np.ndarray:
    """The row's n-grams with the lowest counts (ties by hash), as many that
    two rows which reach the threshold must share one: both hold the share of
    the longer, so neither can leave out more than the rest."""
    n = len(row)
    order = np.lexsort((row, counts[row >> np.uint64(64 - SKETCH_BITS)]))
    return row[order[: n - -(-percent * n // 100) + 1]]


def _counts(docs: DataFrame, like: Similarity) -> np.ndarray:
    """How many rows hold n-grams of each of 2 ** SKETCH_BITS hash ranges.
    Only the order of keys follows from it, never a result."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            for part in A.chunks(batch):
                sets = [x for x in ngram_sets(part.column(0), like.n) if len(x)]
                if sets:
                    at, n = np.unique(np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS), return_counts=True)
                    local[at.astype(np.int64)] += n.astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(local, SKETCH_PARTS)], pa.binary())], names=["part", "packed"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(packed, dtype=np.uint32)
                total[part] = total[part] + values if part in total else values
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "packed"])

    local = map_batches(docs.select("text"), count, "part int, packed binary")
    summed = map_batches(local.repartition("part"), add, "part int, packed binary").collect()  # 4 bytes a counter
    out = {r["part"]: np.frombuffer(r["packed"], dtype=np.uint32) for r in summed}
    empty = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, dtype=np.uint32)
    return np.concatenate([out.get(i, empty) for i in range(SKETCH_PARTS)])


def _may_reach(shared, sizes: tuple, prefixes: tuple, lasts: tuple, percent: int):
    """Whether rows whose rarest n-grams share so many can reach the threshold.
    The row whose prefix ends first has no shared n-gram in it beyond these,
    so the overlap is at most those and the rest of that row."""
    rest = [n - p for n, p in zip(sizes, prefixes, strict=True)]
    most = np.where(lasts[0] < lasts[1], rest[0], np.where(lasts[1] < lasts[0], rest[1], np.maximum(*rest)))
    return (100 + percent) * (shared + most) >= percent * (sizes[0] + sizes[1])


def _last(row: np.ndarray, counts: np.ndarray) -> int:
    """Place of a prefix's last n-gram in the order of keys."""
    return int(counts[row[-1] >> np.uint64(64 - SKETCH_BITS)]) << 32 | int(row[-1] >> np.uint64(32))


def _class_rows(docs: DataFrame, like: Similarity, counts: np.ndarray | None) -> DataFrame:
    """doc_id, a hash of the text, n_shingles, class (null without words) and its block keys
    (null where the task has given those of the class already)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keys_of(row: np.ndarray) -> bytes:
        return (block_keys(row, like.percent) if counts is None else rare_keys(row, like.percent, counts)).tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for part in A.chunks(batch):
                sets = ngram_sets(part.column(2), like.n)
                classes, keys = [], []
                for x in sets:
                    c = int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) if len(x) else None
                    classes.append(c)
                    keys.append(None if c is None or c in given else keys_of(x))
                    given.add(c)
                if len(given) > GIVEN:
                    given.clear()
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(x) for x in sets], pa.int64()), pa.array(classes, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "text_key", "n_shingles", "class", "keys"])

    return map_batches(docs.select("doc_id", F.xxhash64("text"), "text"), rows, f"doc_id {kind}, text_key long, n_shingles long, class long, keys binary")


def _tied(keys: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each one's smallest class, and (key, smaller, larger)
    for the other classes that have it."""
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    head = classes[new][np.cumsum(new) - 1]
    other = head != classes
    other[1:] &= new[1:] | (classes[1:] != classes[:-1])
    return keys[new], classes[new], np.stack([keys[other].view(np.int64), head[other], classes[other]], axis=1)


def _ties(rows: DataFrame) -> DataFrame:
    """(key, a, b): for each block, a tree over the classes that share it."""
    spark = rows.sparkSession
    groups = GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def sent() -> pa.RecordBatch:
            keys, least, ties = _tied(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            group = (keys % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            both = np.stack([keys.view(np.int64), least], axis=1)[order]
            first = np.searchsorted(group[order], np.arange(groups + 1))
            some = np.flatnonzero(np.diff(first))
            out = [(int(g), 0, both[first[g] : first[g + 1]].tobytes()) for g in some]
            if len(ties):
                out.append((int(ties[0, 0] % groups), 1, ties.tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["group", "kind", "packed"])

        for batch in batches:
            for c, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = np.frombuffer(packed, dtype=np.uint64)
                held.append((keys, np.full(len(keys), c, dtype=np.int64)))
                n += len(keys)
                if n >= ENTRIES:
                    yield sent()
                    held, n = [], 0
        if n:
            yield sent()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(ties: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ties[:, i])) for i in range(3)], names=["key", "a", "b"])

        def done(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if held:
                both = np.concatenate(held)
                yield told(_tied(both[:, 0].view(np.uint64), both[:, 1])[2])

        now, held = None, []
        for batch in batches:
            for group, kind, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != now:
                    yield from done(held)
                    now, held = group, []
                values = np.frombuffer(packed, dtype=np.int64)
                if kind:
                    yield told(values.reshape(-1, 3))
                else:
                    held.append(values.reshape(-1, 2))
        yield from done(held)

    packed = map_batches(rows.where("length(keys) > 0").select("class", "keys"), send, "group int, kind int, packed binary")
    return map_batches(packed.repartition("group").sortWithinPartitions("group"), meet, "key long, a long, b long")


def _linked(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """(a, b, linked) with the overlap of each pair counted in full.  Texts
    travel, n-grams are taken where they arrive: hashes have three times the
    bytes and can't be compressed."""

    def sets(classes: pa.Array, column: pa.Array) -> list[np.ndarray]:
        _, first, which = np.unique(classes.to_numpy(), return_index=True, return_inverse=True)
        found = ngram_sets(column.take(pa.array(first)), like.n)
        return [found[i] for i in which]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for some in A.chunks(whole, "text_a") for part in A.chunks(some, "text_b")):
            out = []
            for x, y in zip(sets(batch.column(0), batch.column(2)), sets(batch.column(1), batch.column(3)), strict=True):
                small, large = sorted((len(x), len(y)))
                if 100 * small < like.percent * large:
                    out.append(False)
                    continue
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                out.append(100 * shared >= like.percent * (small + large - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.bool_())], names=["a", "b", "linked"])

    left, right = (texts.select(F.col("class").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
    return map_batches(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), rows, "a long, b long, linked boolean")


def _halved(prefixes: DataFrame, counts: np.ndarray) -> DataFrame:
    """(class, row, size, last): prefixes of rare n-grams with half of each
    hash, and the place of the last.  That is enough for a bound: n-grams that
    share a half count as shared, which only raises it."""

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x, dtype=np.uint64) for x in batch.column(1).to_pylist()]
            halves = [(x & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(halves, pa.binary()), batch.column(2), pa.array([_last(x, counts) for x in rows], pa.int64())], names=["class", "row", "size", "last"])

    return map_batches(prefixes.select("class", "row", "size"), short, "class long, row binary, size long, last long")


def _bounded(pairs: DataFrame, halves: DataFrame, like: Similarity) -> DataFrame:
    """The pairs whose rarest n-grams leave the threshold within reach."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in A.chunks(whole, "row_a")):
            keep = []
            for x, y, n, m, i, j in zip(*(batch.column(k).to_pylist() for k in range(2, 8)), strict=True):
                both = np.sort(np.frombuffer(x + y, dtype=np.uint32))
                shared = int((both[1:] == both[:-1]).sum())
                fits = 100 * min(n, m) >= like.percent * max(n, m)
                keep.append(fits and bool(_may_reach(shared, (n, m), (len(x) // 4, len(y) // 4), (i, j), like.percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    columns = ("row", "size", "last")
    left, right = (halves.select(F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", *[f"{c}_{s}" for c in columns for s in "ab"])
    return map_batches(joined, rows, "a long, b long")


def _texts(classes: DataFrame, rows: DataFrame, docs: DataFrame, like: Similarity) -> DataFrame:
    """(class, size, text): one document of each of the given classes.  Ids may
    repeat or be null, so each text's class is taken anew."""
    one = rows.join(classes, "class", "left_semi").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("__one"))
    same = F.col("doc_id").eqNullSafe(F.col("__one.doc_id")) & (F.xxhash64("text") == F.col("__one.text_key"))
    wanted = docs.join(one, same)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                found = ngram_sets(part.column(1), like.n)
                have = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in found]
                keep = pa.array(np.array(have, dtype=np.int64) == part.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in found], pa.int64()), part.column(1)], names=["class", "size", "text"]).filter(keep)

    return map_batches(wanted.select("class", "text"), own, "class long, size long, text string").dropDuplicates(["class"])


def outline(row: np.ndarray) -> bytes:
    """A bit for each range of hashes that the row has an n-gram in."""
    bits = np.zeros(OUTLINE_BITS, dtype=bool)
    bits[row >> np.uint64(65 - OUTLINE_BITS.bit_length())] = True
    return np.packbits(bits).tobytes()


def _in_outline(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """The pairs whose outlines leave the threshold within reach: each bit that
    one row has alone is an n-gram at least that the other lacks."""

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                bits = [outline(x) for x in ngram_sets(part.column(2), like.n)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bits, pa.binary())], names=["class", "size", "bits"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint64).reshape(-1, OUTLINE_BITS // 64) for i in (4, 5))
            alone = [np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64) for p, q in ((x, y), (y, x))]
            shared = np.minimum(n - alone[0], m - alone[1])
            yield batch.select(["a", "b"]).filter(pa.array((100 + like.percent) * shared >= like.percent * (n + m)))

    found = map_batches(texts.select("class", "size", "text"), outlines, "class long, size long, bits binary")
    left, right = (found.select(F.col("class").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("size", "bits")]) for s in "ab")
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "size_b", "bits_a", "bits_b")
    return map_batches(joined, rows, "a long, b long")


def _sets(texts: DataFrame, like: Similarity) -> DataFrame:
    """(class, row): the n-grams of each class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(batch):
                packed = [x.tobytes() for x in ngram_sets(part.column(1), like.n)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["class", "row"])

    return map_batches(texts.select("class", "text"), rows, "class long, row binary")


def _members(labels: DataFrame, ties: DataFrame, texts: DataFrame) -> DataFrame:
    """(tie, size, class, label, block) of the classes of those components of
    ties that hold several components of links, in blocks of rows by size."""
    tied = ties.withColumnRenamed("node", "class").withColumnRenamed("label", "tie")
    linked = labels.withColumnRenamed("node", "class")
    both = tied.join(linked, "class", "left").withColumn("label", F.coalesce("label", "class"))
    split = both.groupBy("tie").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("tie")
    sized = both.join(split, "tie", "left_semi").join(texts.select("class", "size"), "class")
    rows, _ = numbered(sized.select("tie", "size", "class", "label"), "n")
    return written(rows.withColumn("block", F.expr(f"n div {BLOCK_ROWS}")).drop("n"), "ngram-blocks")


def _members_by_key(labels: DataFrame, ties: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The same by rare n-gram: rows that share it are compared with each
    other alone.  N-grams of two rows have been counted already; of those that
    the same rows share, one stands for all."""
    both = ties.select("key", F.inline(F.array(F.struct(F.col("a").alias("class")), F.struct(F.col("b").alias("class"))))).distinct()
    linked = labels.withColumnRenamed("node", "class")
    labelled = both.join(linked, "class", "left").withColumn("label", F.coalesce("label", "class"))
    of_key = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
    split = of_key.where("n > 2 and low != high").groupBy("n", "rows").agg(F.min("key").alias("key"))
    sized = labelled.join(split.select("key"), "key").join(prefixes.select("class", "size"), "class")
    rows, _ = numbered(sized.select(F.col("key").alias("tie"), "size", "class", "label"), "n")
    return written(rows.withColumn("block", F.expr(f"n div {BLOCK_ROWS}")).drop("n"), "ngram-blocks")


def _product(members: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """(u, v): links between components, by the product of each two blocks of
    rows that share a component of ties and whose sizes can meet.  With `last`
    the rows are halved prefixes, and the pairs those that may link."""
    bound = "last" in sets.columns
    columns = ["class", "tie", "label", "size", "row", *(["last"] if bound else [])]
    spans = members.groupBy("tie", "block").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    x, y = (spans.select("tie", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "least", "most")]) for s in "xy")
    near = (F.col("block_x") <= F.col("block_y")) & (100 * F.col("most_x") >= like.percent * F.col("least_y"))
    pairs = x.join(y, "tie").where(near).select(F.col("block_x").alias("x"), F.col("block_y").alias("y")).distinct()
    rows = members.join(sets, "class")
    left = pairs.join(rows, F.col("x") == F.col("block")).select("x", "y", F.lit(0).alias("side"), *columns)
    right = pairs.where("x != y").join(rows, F.col("y") == F.col("block")).select("x", "y", F.lit(1).alias("side"), *columns)

    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        own, node, tie, label = (t.column(c).to_numpy() for c in ("side", "class", "tie", "label"))
        sets_ = [np.frombuffer(r, dtype=np.uint32 if bound else np.uint64) for r in t.column("row").to_pylist()]
        a = np.flatnonzero(own == 0)
        b = np.flatnonzero(own == 1) if own.any() else a
        sizes = np.array([len(r) for r in sets_], dtype=np.int64)
        _, column = np.unique(np.concatenate(sets_), return_inverse=True)
        row = np.repeat(np.arange(len(sets_)), sizes)
        often = np.bincount(column) > 1  # the others add to no overlap
        row, column = row[often[column]], (np.cumsum(often) - 1)[column[often[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        overlap = np.zeros((len(a), len(b)), dtype=np.int64)
        for low in range(0, int(often.sum()), BLOCK_COLUMNS):
            i, j = np.searchsorted(column, (low, low + BLOCK_COLUMNS))
            dense = np.zeros((len(sets_), BLOCK_COLUMNS), dtype=np.float32)
            dense[row[i:j], column[i:j] - low] = 1
            overlap += (dense[a] @ dense[b].T).astype(np.int64)  # each product is exact
        if not bound:
            reach = 100 * overlap >= like.percent * (sizes[a][:, None] + sizes[b][None, :] - overlap)
        else:
            full, last = t.column("size").to_numpy().astype(np.int64), t.column("last").to_numpy()
            # n-grams of a row whose halves are equal have one column
            merged = np.array([len(r) - len(np.unique(r)) for r in sets_], dtype=np.int64)
            reach = _may_reach(overlap + merged[a][:, None], (full[a][:, None], full[b][None, :]), (sizes[a][:, None], sizes[b][None, :]), (last[a][:, None], last[b][None, :]), like.percent)
        good = reach & (tie[a][:, None] == tie[b][None, :]) & (label[a][:, None] != label[b][None, :]) & (node[a][:, None] != node[b][None, :])
        u, v = np.nonzero(good)
        return pa.RecordBatch.from_arrays([pa.array(node[a][u]), pa.array(node[b][v])], names=["u", "v"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(x)], strict=True):
                if j > i:
                    if held and now != (x[i], y[i]):
                        yield links(held)
                        held = []
                    now = (x[i], y[i])
                    held.append(batch.slice(i, j - i))
        if held:
            yield links(held)

    met = left.union(right).repartition("x", "y").sortWithinPartitions("x", "y")
    return map_batches(met, meet, "u long, v long")


def ngram_components(docs: DataFrame, like: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (the
    smallest doc_id that links reach), `class`, equal for equal sets,
    `component`, equal for linked sets, and `text_key`, a hash of the text.

    A null, empty or blank text has no n-grams, links with nothing and keeps
    its own id; rows whose doc_id is null have the component of their text,
    which is null if no row in it has an id.
    """
    docs = id_and_text(docs, id_col, text_col)
    small_batches(docs.sparkSession)
    counts = None if like.in_blocks else _counts(docs, like)
    keyed = settled(_class_rows(docs, like, counts), "ngram-rows")
    ties = settled(_ties(keyed), "ngram-ties")
    if not like.in_blocks:
        own = keyed.where("length(keys) > 0").select("class", F.col("keys").alias("row"), F.col("n_shingles").alias("size"))
        prefixes = settled(own.dropDuplicates(["class"]), "ngram-prefixes")
    rows = settled(keyed.drop("keys"), "ngram-classes")  # keys are most of the bytes
    removed(keyed)

    def linked(of: DataFrame, many: bool = False) -> tuple[DataFrame, DataFrame]:
        """The links among the pairs, and a text of each of their classes."""
        classes = of.select(F.col("a").alias("class")).union(of.select(F.col("b").alias("class"))).distinct()
        texts = settled(_texts(classes, rows, docs, like), "ngram-texts")
        if many:
            of = settled(_in_outline(of, texts, like), "ngram-pairs")
        return settled(_linked(of, texts, like).where("linked").select(F.col("a").alias("u"), F.col("b").alias("v")), "ngram-links"), texts

    # tables go as soon as they have been read for the last time
    if like.in_blocks:
        pairs = ties.select("a", "b").distinct()
        links, texts = linked(pairs)
        labels = components(links)
        members = _members(labels, components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))), texts)
        removed(ties)
        rest = settled(_product(members, _sets(texts, like), like), "ngram-rest")
        removed(members, texts)
    else:
        halves = _halved(prefixes, counts)
        pairs = settled(_bounded(ties.select("a", "b").distinct(), halves, like), "ngram-pairs")
        links, texts = linked(pairs)
        removed(pairs, texts)
        labels = components(links)
        members = _members_by_key(labels, ties, prefixes)
        removed(ties)
        more = settled(_product(members, halves.drop("size"), like).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "ngram-pairs")
        removed(members, prefixes)
        rest, texts = linked(more, many=True)
        removed(more, texts)
    if not rest.isEmpty():  # components found so far are stars, which new links join
        labels = components(labels.select(F.col("node").alias("u"), F.col("label").alias("v")).union(rest))
    ids = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("__first"))
    ids = ids.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    first = ids.groupBy("label").agg(F.min("__first").alias("component_id"))
    of_class = ids.join(first, "label").select("class", "component_id", F.col("label").alias("component"))
    out = rows.join(of_class, "class", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "class", "component", "text_key")


def one_of_each(docs: DataFrame, like: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with the smallest id of each component (a null id
    counts as the largest), one row of those with equal id and text.  Texts
    without words link with nothing and all stay."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = ngram_components(docs, like, id_col, text_col).where("component is not null")
    kept = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("__one"))
    kept = kept.select(F.col("__one.doc_id").alias("__kept_id"), F.col("__one.text_key").alias("__kept_key"))
    has_words = text.rlike("[^\\x20\\x09-\\x0D]")
    own = docs.where(has_words).withColumn("__key", F.xxhash64(text))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__kept_id")) & (F.col("__key") == F.col("__kept_key"))
    chosen = own.join(kept, same, "left_semi").dropDuplicates([id_col, "__key"]).drop("__key")
    return chosen.union(docs.where(~has_words))
