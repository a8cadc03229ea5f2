"""The shared folder for intermediate tables and files."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

LOCAL = "/tmp/checkpoints/terrace"


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where that is unset and Spark runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or LOCAL).rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is there yet."""
    return f"{root(spark)}/{name}/{uuid.uuid4().hex}"
