"""Shared scratch folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session that names none gets a temporary folder, once.  On a
    cluster a missing setting is an error: executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_root()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder path below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
