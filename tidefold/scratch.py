"""A folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; below a local one only where the session has none (tests)."""
    top = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tidefold-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
