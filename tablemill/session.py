"""Session settings and the shared folder that every written intermediate goes to."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app_name: str, cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and timing; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@functools.cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tablemill-{application_id}-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the one the cluster shares between its executors.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session, where the driver and the
    executors are one process, may fall back to a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
