"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used in local mode; on a
    cluster it is an error, because executors do not share one machine's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="scratch-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
