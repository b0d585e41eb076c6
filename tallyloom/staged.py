"""Tables between the steps of a job, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DIR = "spark.__tallyloom.dir"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset a local master gets a
    temporary one, and a cluster must name one.  Tables of an application lie together and may go
    when it has ended.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(_DIR, base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again: rows, their order in files and any choice among ties are then the same for all readers."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
