"""Session and scratch-location helpers.

Library operators never create a session: they take the caller's.
``local_session`` exists for tests and the bench only.  Scratch output
(snapshots, stream sinks, CSV round trips) goes under the shared folder
the cluster names in ``spark.checkpoint.dir``; a default is set only
when the session has none, as in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULT_SCRATCH = os.path.join(tempfile.gettempdir(), "tillscope-checkpoints")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillscope") -> SparkSession:
    """A local session for tests and the bench (UTC, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # the test tables are files of one row group, which scan as one task: joins beyond this spread them
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # a test counts what its own executions scanned: a whole suite's stay listed (1,000 by default)
        .config("spark.sql.ui.retainedExecutions", "20000")
        .config("spark.driver.memory", os.environ.get("TILLSCOPE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only if unset.

    The folder named by ``spark.checkpoint.dir`` wins.  A machine-local
    default is used only for a local master (tests); on a cluster an unset
    folder is an error, because executors would not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = _LOCAL_DEFAULT_SCRATCH
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tillscope/{name}-{uuid.uuid4().hex[:12]}"
