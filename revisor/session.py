"""Session construction and the shared staging folder.

On a cluster the session is created by the launcher; ``build_session`` is for
local runs (tests, bench).  ``stage_dir`` returns a fresh folder inside the
cluster's ``spark.checkpoint.dir``: intermediate tables written there survive
executor loss and cut lineage; ``release`` removes one.  A local temporary
folder is only chosen when that setting is absent and the master is local;
elsewhere a missing setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "revisor",
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set to a local temp folder only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the SQL conf is visible
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    if not configured and sc is not None:
        configured = sc.getConf().get(_CHECKPOINT_KEY)
    if not configured:
        # Local runs and tests only: a cluster must name a shared folder.
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{_CHECKPOINT_KEY} is not set: staged tables need a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="revisor-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "revisor-stage", f"{name}-{uuid.uuid4().hex}")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release(spark: SparkSession, *paths: str) -> None:
    """Remove staged folders that nothing reads any more."""
    for path in paths:
        file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
