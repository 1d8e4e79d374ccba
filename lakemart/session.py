"""Session setup and lineage helpers.

Every operator in the package is a lazy ``DataFrame -> DataFrame`` function;
this module only owns the few session-level settings they rely on.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the operators assume.  Time zone is pinned because
# surrogate keys hash ``cast(timestamp as string)`` and must not change with
# the cluster's locale.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "lakemart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster use the session the platform gives
    and call :func:`configure` on it instead."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:
        pass
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for k, v in BASE_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    storage).  When it is unset, a single-process ``local`` master (tests,
    local runs) gets a fresh directory, recorded in the session; any other
    master raises, because executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to storage that the driver and all "
                             f"executors share (master is {master or 'unknown'!r})")
        root = tempfile.mkdtemp(prefix="lakemart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:                        # classic sessions: also register it for RDD checkpoints
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
    except Exception:           # Spark Connect has no SparkContext; tables suffice
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/scratch/{name}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove ``path`` when the application ends (readers may still need it
    until then).  A Connect session has no JVM handle; its scratch folder is
    cleaned by whoever owns ``spark.checkpoint.dir``."""
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    except Exception:
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(jsc.hadoopConfiguration()).deleteOnExit(p)


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a DataFrame reading it back.

    Survives executor loss (shared storage) and computes ``df`` once --
    an eager reliable ``Dataset.checkpoint`` runs the plan twice (once to
    count, once to write) unless the data is also cached.  The read-back is
    columnar, so later steps prune columns and push filters into it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.  They go when
    the driver's JVM collects the plans that refer to them; an iterative job
    fills the disks long before the driver's heap calls for a collection."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:           # Spark Connect: the server keeps its own pace
        return
    gc.collect()
    jvm.System.gc()
