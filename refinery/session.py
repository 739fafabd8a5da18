"""Session helpers: a tuned builder for tests/bench and the shared workspace.

Jobs never pick a machine-local folder on their own: intermediate tables go
under the folder named by ``spark.checkpoint.dir`` (shared storage on a
cluster).  Only when the session leaves it unset -- tests, local runs -- do we
create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC + NTZ timestamps keep results free of the
# machine's zone; AQE coalesces small shuffle partitions and splits skewed ones.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "refinery", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster job would pass its own conf.

    ``event_log_dir`` turns on Spark's event log there (read back by
    ``sources.eventlog`` for the per-job history).
    """
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True) if local_path(event_log_dir) else None
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_settings(spark)
    return spark


def ensure_session_settings(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="refinery-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def workspace(spark: SparkSession, *parts: str) -> str:
    """A folder under the checkpoint root for tables written by our jobs."""
    return "/".join([checkpoint_root(spark), "refinery", *parts])


def fresh_workspace(spark: SparkSession, label: str) -> str:
    """A new, never-used folder for one pipeline run."""
    return workspace(spark, "runs", f"{label}-{uuid.uuid4().hex[:12]}")


def local_path(path: str) -> str | None:
    """Plain filesystem path for ``file:`` or bare paths, else None."""
    if path.startswith("file:"):
        return path[5:]
    if "://" in path:
        return None
    return path if os.path.isabs(path) else None
