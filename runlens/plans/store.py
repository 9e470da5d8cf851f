"""The append-only store behind the published tables, and its manifest.

Events and partials lie in *segments*: four tables that one commit has written
and nothing writes again (``events``, ``run_partials``, ``fact_partials`` and
``error_partials``, with the segment's name behind).  A rebuild starts a new
*generation* with a base segment; each batch adds a segment, and a merge puts
one in the place of several.

``refresh_log`` is the manifest: one row per commit, which names the segment
it adds and those it replaces.  A segment counts from the moment its row is
there, and what a failed attempt wrote is never seen.  As the log grows it is
rolled into a new *era*, one file with the live segments and the ranges of
batch ids that have been committed, so that reading it costs the same after
any number of batches.

``versions`` has a row per publish: the segments and the cutoff it shows.  All
published views follow its last row, so one appended row switches them all.

Segments may differ in schema: columns, fields of ``origin`` and wider types
that a batch brings are put together when segments are read.

Single writer per database, any number of readers.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.config import Config
from runlens.sources.logs import LogSource, align, common_schema, quote
from runlens.sources.sinks import table_name, write_table

LOG_KEY, VERSIONS_KEY = "refresh_log", "versions"
EVENTS, RUNS, FACTS, ERRORS = "events", "run_partials", "fact_partials", "error_partials"
SEGMENT_KEYS = (EVENTS, RUNS, FACTS, ERRORS)
#: Files that a rebuild has read, in a table for each generation.
COVERED_KEY = "covered_files"
DATE_COLUMN = "event_date"
FILE_COLUMN = "__file_path"

LOG_SCHEMA = (
    "kind string, generation int, source string, first_batch long, last_batch long, segment string, level int,"
    " replaces array<string>, from_time timestamp_ntz, as_of timestamp_ntz, era int"
)
VERSION_SCHEMA = "generation int, segments array<string>, cutoff timestamp_ntz, as_of timestamp_ntz, version int"
# Kinds of rows of the manifest: commits, and what an era begins with.
BATCH, MERGE, LIVE, DONE = "batch", "merge", "live", "done"
#: The level of a rebuild's segment, which no merge takes.
BASE = 1 << 20
# Commits after which the manifest is rolled into a new era.
ROLL_AFTER = 16


@dataclass(frozen=True)
class Manifest:
    """What the log says: live segments of the last generation, by level."""

    generation: int
    segments: dict[str, int]
    from_time: dt.datetime | None
    era: int
    commits: int
    done: bool

    def at_level(self, level: int) -> list[str]:
        return [s for s, n in self.segments.items() if n == level]


@dataclass(frozen=True)
class Version:
    version: int
    generation: int
    segments: tuple[str, ...]


class Store:
    """Names and committed contents of one database's tables."""

    def __init__(self, spark: SparkSession, database: str, cfg: Config):
        self.spark, self.database, self.cfg = spark, database, cfg

    def name(self, key: str, segment: str = "") -> str:
        return table_name(self.database, self.cfg.table_prefix, f"{key}_{segment}" if segment else key)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def table(self, name: str) -> DataFrame:
        # another session may have appended: forget this one's file listing
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def append(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
        if not self.exists(name):
            write_table(df, name, self.cfg.output_format, partition_by)
            return
        w = df.write.mode("append").format(self.cfg.output_format)
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)

    def tables(self, pattern: str) -> list[tuple[str, re.Match]]:
        """Tables of the prefix whose key fits the pattern."""
        pat = re.compile(rf"^{re.escape(self.cfg.table_prefix)}{pattern}$")
        names = [r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN {quote(self.database)}").collect()]
        return sorted((n, m) for n in names if (m := pat.match(n)))

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {quote(self.database)}.{quote(table)}")

    def _numbers(self, name: str, column: str) -> list[int]:
        """The partitions of a table that is partitioned by a number."""
        return [int(row[0].removeprefix(f"{column}=")) for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]

    def reread(self) -> None:
        """Make this session see what others have written to the store."""
        for key in (LOG_KEY, VERSIONS_KEY, "consolidated_events"):
            if self.exists(self.name(key)):
                self.spark.catalog.refreshTable(self.name(key))

    # ------------------------------------------------------------ the manifest

    def manifest(self, source: str = "", batch_id: int = -1) -> Manifest:
        """The state after the last commit; ``done``: whether this batch has
        been committed, in any generation.  Rows that meet here are those of
        live segments, of at most ``ROLL_AFTER`` commits, and of one batch."""
        name = self.name(LOG_KEY)
        if not self.exists(name):
            return Manifest(0, {}, None, 0, 0, False)
        era = max(self._numbers(name, "era"), default=0)  # a partition is listed when its file is there
        mine = (F.col("source") == source) & (F.lit(int(batch_id)).between(F.col("first_batch"), F.col("last_batch")))
        log = self.table(name).filter(F.col("era") == era).withColumn("mine", F.coalesce(mine, F.lit(False)))
        rows = log.filter((F.col("kind") != DONE) | F.col("mine")).collect()
        generation = max((r["generation"] for r in rows if r["kind"] != DONE), default=0)
        own = [r for r in rows if r["generation"] == generation and r["kind"] != DONE]
        # files are listed in any order; first-seen names of columns must not depend on it
        own.sort(key=lambda r: (-(r["level"] or 0), r["kind"] != LIVE, -1 if r["first_batch"] is None else r["first_batch"], r["source"] or ""))
        gone = {s for r in own for s in r["replaces"] or ()}
        live = {r["segment"]: r["level"] for r in own if r["segment"] not in gone}
        return Manifest(generation, live, max((r["from_time"] for r in own if r["from_time"]), default=None), era, sum(r["kind"] in (BATCH, MERGE) for r in rows), any(r["mine"] for r in rows))

    def commit(self, manifest: Manifest, kind: str, generation: int, segment: str, level: int = 0, source: str | None = None, batch_id: int | None = None, replaces: Iterable[str] = (), from_time: dt.datetime | None = None) -> None:
        row = (kind, generation, source, batch_id, batch_id, segment, level, list(replaces), from_time, self.cfg.as_of, manifest.era)
        self.append(self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1), self.name(LOG_KEY), ["era"])
        if manifest.commits + 1 >= ROLL_AFTER:
            self._roll()

    def _roll(self) -> None:
        """Begin a new era: one file, so that it is there as a whole or not."""
        now, name = self.manifest(), self.name(LOG_KEY)
        log = self.table(name).filter(F.col("era") == now.era)
        done = log.filter(F.col("kind").isin(BATCH, DONE) & F.col("source").isNotNull())
        before = Window.partitionBy("source").orderBy("first_batch", "last_batch").rowsBetween(Window.unboundedPreceding, -1)
        starts = F.coalesce(F.col("first_batch") > F.max("last_batch").over(before) + 1, F.lit(True)).cast("long")
        ranges = done.withColumn("starts", starts).withColumn("island", F.sum("starts").over(Window.partitionBy("source").orderBy("first_batch", "last_batch")))
        ranges = ranges.groupBy("source", "island").agg(F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch"))
        live = [(LIVE, now.generation, None, None, None, s, n, [], now.from_time, self.cfg.as_of, now.era + 1) for s, n in now.segments.items()]
        rows = self.spark.createDataFrame(live, LOG_SCHEMA)
        empty = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields}
        kept = {**empty, "kind": F.lit(DONE), "generation": F.lit(now.generation), "era": F.lit(now.era + 1), **{c: F.col(c) for c in ("source", "first_batch", "last_batch")}}
        rows = rows.unionByName(ranges.select(*[kept[f.name].alias(f.name) for f in rows.schema.fields]))
        self.append(rows.coalesce(1), name, ["era"])
        for era in self._numbers(name, "era"):
            if era < now.era:  # the era before stays for who is reading it
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (era = {era})")

    # ------------------------------------------------------------ the segments

    def new_segment(self, generation: int, base: bool = False) -> str:
        return f"g{generation}" if base else f"{uuid.uuid4().hex[:10]}_g{generation}"

    def partials(self, key: str, segments: Iterable[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.table(self.name(key, s)) for s in segments])

    def event_schema(self, segments: Iterable[str], *more: DataFrame) -> T.StructType:
        """The columns of all segments' events (and more batches) together,
        with types that hold all; ``SchemaClashError`` where none does."""
        frames = [(s, self.spark.table(self.name(EVENTS, s)).drop(DATE_COLUMN)) for s in segments]
        frames += [("the batch", df) for df in more]
        return common_schema([LogSource("store", EVENTS, s, df.drop(FILE_COLUMN)) for s, df in frames])

    def events(self, segments: Iterable[str]) -> DataFrame:
        """Consolidated events of the segments, with their date."""
        segments = list(segments)
        target = self.event_schema(segments)
        dated = T.StructType([*target.fields, T.StructField(DATE_COLUMN, T.DateType())])
        return reduce(DataFrame.union, [align(self.spark.table(self.name(EVENTS, s)), dated) for s in segments])

    def segments_of(self, generation: int) -> set[str]:
        """Names of the generation's segments that have tables, live or not."""
        keys = "|".join(SEGMENT_KEYS)
        return {m.group(1) for _, m in self.tables(rf"(?:{keys})_((?:[0-9a-f]{{10}}_)?g{generation})")}

    def last_generation(self) -> int:
        """The highest number that any segment's table has."""
        return max((int(m.group(1)) for _, m in self.tables(r"\w+_g(\d+)")), default=0)

    def drop_segments(self, segments: Iterable[str]) -> None:
        for s in segments:
            for key in SEGMENT_KEYS:
                self.drop(f"{self.cfg.table_prefix}{key}_{s}")

    # ------------------------------------------------------------ the versions

    def versions(self) -> list[Version]:
        """The last two publishes, the latest first."""
        name = self.name(VERSIONS_KEY)
        if not self.exists(name):
            return []
        rows = sorted(self.table(name).collect(), key=lambda r: -r["version"])
        return [Version(r["version"], r["generation"], tuple(r["segments"])) for r in rows[:2]]

    def switch(self, version: int, manifest: Manifest) -> None:
        """All published views show this version from here on."""
        row = (manifest.generation, list(manifest.segments), self.cfg.cutoff, self.cfg.as_of, version)
        self.append(self.spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1), self.name(VERSIONS_KEY), ["version"])

    def shown(self, column: str, among: Iterable[str] | None = None) -> str:
        """SQL: this column of the version that the views show; ``among``: of
        the last version that has these segments and no others, so that a plan
        made before a switch goes on with the version that it knows."""
        where = ""
        if among is not None:
            known = ", ".join(f"'{s}'" for s in among)
            where = f" WHERE size(array_except(segments, array({known}))) = 0"
        return f"(SELECT max_by({column}, version) FROM {self.name(VERSIONS_KEY)}{where})"

    def drop_versions(self, keys: Iterable[str], before: int) -> None:
        for key in (*keys, VERSIONS_KEY):
            name = self.name(key)
            for n in self._numbers(name, "version"):
                if n < before:
                    self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (version = {n})")
