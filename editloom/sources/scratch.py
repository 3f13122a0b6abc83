"""Folders for files that a job makes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new name below the folder that all executors share, ``spark.checkpoint.dir``; one of our own in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='editloom-')}"
    return f"{found.rstrip('/')}/{label}-{uuid.uuid4().hex}"
