"""Session construction and shared work folders.

`get_session` is for tests, the bench and local use; on a cluster the caller
owns the session. `work_dir` always reads `spark.checkpoint.dir` from the
session first, so every table or checkpoint an operator writes lands in the
cluster's shared folder; only when that setting is unset (local tests) does
it create one under the system temp folder and record it on the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, app: str = "stratum",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.stratum.input.partitions", str(shuffle_partitions or int(cpus)))
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Set here only when unset and Spark runs in local mode (tests, one
    machine); on a cluster a machine-local folder would not be shared by the
    executors, so an unset setting is an error there.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the conf is visible
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    try:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
    except Exception:  # the conf is enough
        pass
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
