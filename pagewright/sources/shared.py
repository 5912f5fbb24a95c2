"""The folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset, a local master has a temporary folder of its own; a cluster has to set it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        found = _own.setdefault(app, _own.get(app) or "file://" + tempfile.mkdtemp(prefix="pagewright-"))
    return f"{found.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write a table into the shared folder and read it again, so that several readers don't make it several times."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
