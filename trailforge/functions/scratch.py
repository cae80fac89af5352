"""Folders for intermediate files, where the driver and all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one where the session names none and is one process."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="work-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
