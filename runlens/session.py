"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a refresh job wants; tests and the bench use them on local[N].
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete checkpoint files once the DataFrames that used them are gone,
    # so a long-lived refresh driver does not fill the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "runlens", **conf) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    if master.startswith("local") and "spark.sql.warehouse.dir" not in conf:
        # local sessions (tests, bench): keep the default schema's folder out
        # of the working directory
        conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="runlens-warehouse-")
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for sessions without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder.  Only a local-mode session
    (tests) without one gets a fresh private folder; on a cluster the
    setting must name shared storage, so its absence is an error."""
    sc = _context(spark)
    d = checkpoint_dir(spark)
    if d:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    d = tempfile.mkdtemp(prefix="runlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the checkpoint folder (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "runlens", *parts])


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder for one job's written tables."""
    import uuid

    return scratch_path(spark, f"{label}-{os.getpid()}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Checkpoint ``df`` to the shared checkpoint folder (eager): used where
    several branches of one plan consume the same intermediate result, so
    the work behind it runs once and its lineage is cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
