"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir.  Only where the session names none and runs on
    one machine (tests) a local one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spotgrain-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")
