"""Line dedup: keep bitmaps from a range-partitioned stream of line hashes.

A line's key is the line without blanks at its ends, A-Z lower-cased; 128 bits
of hash stand for it.  Lines are reduced to (hash, document, word of 64 line
places, bits) before they move, so that a line repeated within a document is
one row.  These rows are range-partitioned by hash and document and sorted by
hash, document and place: a hash that a third of all documents hold spreads
over as many partitions ("blocks") as it fills.

Each block is then read as a stream: a row is the first of its document or
not, the first of its key or not.  A key can go over the edge of a block, but
only the first and the last key of each block do, so the counts that blocks
pass on are two rows a block at most.

What comes back is, for each document that loses lines, a bitmap of the lost
lines; words of 64 lines that lose none are left out.  No text moves for it.

A document is what its id and its text say: rows that repeat both count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.tables import id_and_text, written

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What tells documents apart, and keys of lines.
DOCUMENT = ["doc_id", "t1", "t2"]
KEY = ["h1", "h2"]


@dataclass(frozen=True)
class Repeats:
    """Which lines go: those whose key has `least_chars` code points and is in
    `min_documents` documents; `keep_first` spares the key's first line, in
    the order of document and place."""

    min_documents: int = 10
    least_chars: int = 1
    keep_first: bool = False


def line_key(line: Column) -> Column:
    """Blanks off both ends, A-Z lower-cased and nothing else."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() is right, and faster, for text that is all ASCII
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _two_hashes(value: Column) -> tuple[Column, Column]:
    """128 bits: the hash under two seeds."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t1, t2 = _two_hashes(F.col("text"))
    return id_and_text(docs, id_col, text_col).withColumns({"t1": t1, "t2": t2})


def line_places(docs: DataFrame, rules: Repeats) -> DataFrame:
    """(hash, document, word, bits): the places of a key in a document, 64 to
    a word."""
    lines = docs.select(*DOCUMENT, F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    keys = lines.select(*DOCUMENT, "place", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= rules.least_chars)
    h1, h2 = _two_hashes(F.col("key"))
    rows = keys.select(h1.alias("h1"), h2.alias("h2"), *DOCUMENT, F.expr("int(place div 64)").alias("word"), F.expr("shiftleft(1L, place % 64)").alias("bit"))
    return rows.groupBy(*KEY, *DOCUMENT, "word").agg(F.bit_or("bit").alias("bits"))


def _blocks(places: DataFrame) -> DataFrame:
    """The rows in sorted blocks.  Written, since a block's number has to stay."""
    by = [*KEY, *DOCUMENT]
    return written(places.repartitionByRange(*by).sortWithinPartitions(*by, "word").withColumn("block", F.spark_partition_id()), "line-blocks")


def _streamed(blocks: DataFrame) -> DataFrame:
    """Each row with `documents`, those with its key in its block, and
    `leads`, whether it is the key's first row in its block."""
    key = Window.partitionBy("block", *KEY)
    stream = key.orderBy(*DOCUMENT, "word")
    same = [F.lag(c).over(stream).eqNullSafe(F.col(c)) for c in DOCUMENT]
    seen = blocks.withColumn("leads", F.row_number().over(stream) == 1)
    seen = seen.withColumn("fresh", (F.col("leads") | ~(same[0] & same[1] & same[2])).cast("long"))
    return seen.withColumn("documents", F.sum("fresh").over(key)).drop("fresh")


def _carried(blocks: DataFrame, streamed: DataFrame) -> DataFrame:
    """(hash, first block, documents) of keys that go over a block's edge: at
    most one a block, since such a key is the last of one block and the first
    of another."""
    key = F.struct(*KEY)
    ends = blocks.groupBy("block").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    edges = ends.select("block", F.explode(F.array_distinct(F.array("low", "high"))).alias("edge")).select("block", "edge.*")
    shared = edges.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("first_block")).filter("n > 1").drop("n")
    parts = streamed.filter("leads").select("block", *KEY, "documents").join(F.broadcast(shared), KEY)
    return parts.groupBy(*KEY, "first_block").agg(F.sum("documents").alias("all_documents"))


def lost_lines(docs: DataFrame, rules: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, t1, t2, lost): the bitmap of each document that loses lines.

    `lost` is a list of (word, bits) by word; bit b of word w stands for line
    64 * w + b.  t1 and t2 are the hashes of the text.  A null text is an
    empty one, which is one empty line; a null id is an id of its own.  Rows
    that repeat id and text are one document.  No rows give no rows; other
    columns aren't read.
    """
    blocks = _blocks(line_places(_documents(docs, id_col, text_col), rules))
    streamed = _streamed(blocks)
    # at most one row for each block, so the size is that of the cluster's plan
    whole = streamed.join(F.broadcast(_carried(blocks, streamed)), KEY, "left")
    lost = whole.filter(F.coalesce("all_documents", "documents") >= rules.min_documents)
    if rules.keep_first:
        first = F.col("leads") & (F.col("block") == F.coalesce("first_block", "block"))
        lost = lost.withColumn("bits", F.when(first, F.expr("bits & (bits - 1)")).otherwise(F.col("bits"))).filter("bits <> 0")
    words = lost.groupBy(*DOCUMENT, "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("lost"))


def _applied(docs: DataFrame, rules: Repeats, id_col: str, text_col: str) -> DataFrame:
    """(row, text, bitmap, lines): the whole row, its text (null: empty), the
    bitmap up to the last word with a lost line, and the lines."""
    gap = "array_repeat(0L, x.word - coalesce(get(lost, i - 1).word, -1) - 1)"
    bitmaps = lost_lines(docs, rules, id_col, text_col).select(*[F.col(c).alias(f"of_{c}") for c in DOCUMENT], F.expr(f"flatten(transform(lost, (x, i) -> array_append({gap}, x.bits)))").alias("bitmap"))
    # written, so that Spark can split a hot document's side of the join
    bitmaps = written(bitmaps, "line-bitmaps")
    id_, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    t1, t2 = _two_hashes(text)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), id_.alias("doc_id"), text.alias("text"), t1.alias("t1"), t2.alias("t2"))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("t1") == F.col("of_t1")) & (F.col("t2") == F.col("of_t2"))
    return rows.join(bitmaps, same, "left").select("row", "doc_id", "text", "bitmap", _lines(F.col("text")).alias("lines"))


def _kept() -> Column:
    """The text without its lost lines; lines past the bitmap's end stay."""
    word = lambda i: F.coalesce(F.get("bitmap", F.shiftright(i, 6)), F.lit(0).cast("long"))
    left = F.filter("lines", lambda _, i: F.getbit(word(i), i.bitwiseAND(63)) == 0)
    return F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))


def without_lines(docs: DataFrame, rules: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, their texts without the lost lines.

    Cases as in `lost_lines`; a text that loses nothing, a null one too, stays
    as it is, and one that loses all lines is empty.
    """
    own = {c: F.col("row").getField(c) for c in docs.columns}
    text = F.when(F.col("bitmap").isNull(), own[text_col]).otherwise(_kept())
    return _applied(docs, rules, id_col, text_col).select(*[(text if c == text_col else v).alias(c) for c, v in own.items()])


def line_report(docs: DataFrame, rules: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, n_lines, n_dropped and the SHA-256
    of the text that stays.  Cases as in `lost_lines`."""
    dropped = F.expr("aggregate(coalesce(bitmap, array()), 0L, (n, bits) -> n + bit_count(bits))")
    return _applied(docs, rules, id_col, text_col).select("doc_id", F.size("lines").cast("long").alias("n_lines"), dropped.alias("n_dropped"), F.sha2(_kept(), 256).alias("kept_sha256"))


def duck_sql(rules: Repeats = Repeats()) -> str:
    """The rows of `line_report` in DuckDB."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        line AS (
            SELECT doc_id, text, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs
        ), keyed AS (
            SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{UPPER.lower()}') AS key FROM line
        ), frequent AS (
            SELECT key FROM keyed WHERE length(key) >= {rules.least_chars} GROUP BY key HAVING count(DISTINCT (doc_id, text)) >= {rules.min_documents}
        ), marked AS (
            SELECT k.doc_id, k.line, k.place, f.key IS NOT NULL AS lost FROM keyed k LEFT JOIN frequent f ON f.key = k.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id"""
