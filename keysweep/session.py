"""Session settings and the shared scratch folder.

Staged tables and snapshots of intermediate results go under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system). Only a
local-mode session without that setting gets a fresh temporary folder, as in
tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a local session (tests, bench). A cluster brings its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", app: str = "keysweep", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged data: the session's checkpoint folder.

    Order: a folder already set on the context, then ``spark.checkpoint.dir``
    from the session; only a local master may fall back to a new temporary
    folder (which is then also set as the checkpoint folder).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder for staged data"
        )
    folder = tempfile.mkdtemp(prefix="keysweep-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder name under the checkpoint root (not created)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/keysweep/{purpose}-{uuid.uuid4().hex}"
