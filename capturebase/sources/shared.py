"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir. On one machine, as in tests, a temporary folder where that is unset; a cluster must set it, as
    its executors can't read each other's disks."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="capturebase-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"
