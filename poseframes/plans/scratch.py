"""Where queries put the files that they write and read again."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _local() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A new place in the folder that ``spark.checkpoint.dir`` names. Where it is unset, a folder of
    this machine stands in for it if Spark runs in this process alone; a cluster could not share it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
