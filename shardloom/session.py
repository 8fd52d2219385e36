"""Session helpers: building a session for local runs and finding the shared
checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names
(a shared, fault-tolerant path).  Only when it is unset *and* Spark runs in
local mode do we make one under ``/tmp``; a cluster without the setting is an
error, because a machine-local folder would not survive executor loss.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames no longer referenced are removed by Spark's
    # own cleaner (local runs write many small checkpoints)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.cleaner.periodicGC.interval": "1min",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shardloom", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "12g"))
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM; ``local-cluster[...]`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Spark Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no local context
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Sets a private one only
    when it is unset and the master is local (tests, bench).  A remote
    session manages its checkpoint folder on the server side.
    """
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        conf = tempfile.mkdtemp(prefix="shardloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("this session names no shared folder (spark.checkpoint.dir)")
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
