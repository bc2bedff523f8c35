"""Where a job may leave intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and tasks share one disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="gaugeframe-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
