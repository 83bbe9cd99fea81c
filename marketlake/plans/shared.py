"""Shared folder for tables and checkpoints that must outlive an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every session must set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/marketlake-{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, folder: str) -> None:
    """Empty a scratch table that is done with: an empty one takes its place, which frees its files."""
    spark.createDataFrame([], "gone boolean").coalesce(1).write.mode("overwrite").parquet(folder)
