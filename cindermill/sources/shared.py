"""Scratch folders that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; unset, and all in one process, as in tests, under a temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cindermill-")
        spark.sparkContext.setCheckpointDir(path)
    return f"{path.rstrip('/')}/{name}/{uuid.uuid4().hex}"
