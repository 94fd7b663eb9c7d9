"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session without that setting gets a temporary one."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="gristmill-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
