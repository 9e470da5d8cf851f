"""Given tables, and tables written in the shared folder between stages."""

from __future__ import annotations

import gc
import os
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import new_scratch


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it,
    for runs from other folders (a cluster installs it or gets --py-files)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """df.mapInArrow for functions of this package."""
    importable(df.sparkSession)
    return df.mapInArrow(fn, schema)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, label: str) -> DataFrame:
    """Write df in the folder of spark.checkpoint.dir and read it again: its
    lineage ends there, and a lost executor costs no more than a new read."""
    path = new_scratch(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[back] = path
    return back


def removed(*tables: DataFrame) -> None:
    """Delete the files of `written` tables that nothing will read again."""
    for df in tables:
        path = _FOLDERS.pop(df, None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


# Spark removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, label: str) -> DataFrame:
    """`written`, with the step's shuffle files removed at its end, and those
    of earlier steps once the driver has collected their plans: else they stay
    as long as the driver has memory to spare.  Only the result is read again."""
    spark = df.sparkSession
    gc.collect()
    spark._jvm.System.gc()
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return written(df, label)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Arrow batches of at most so many bytes from now on, for rows that hold
    arrays: the JVM and its Python workers keep several batches each."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > most:
        spark.conf.set(key, str(most))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that most operators need, a null text as an empty one."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
