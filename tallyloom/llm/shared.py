"""The shared folder that jobs cut lineage in, and small helpers that every operator uses."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.staged import scratch, staged

#: Column names that operators use inside start with this, so that they clash with no column of the input.
OWN = "__loom_"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the driver and all executors share."""
    return scratch(spark, name)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: what follows survives lost executors without repeating what came before,
    and rows, partitions and any choice among ties are the same for every later reader.
    """
    return staged(df, name)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside drop their shuffle files at their end, not when the driver next collects garbage; for jobs that write a table."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns: equal rows have equal hashes."""
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if kind.startswith(("map", "variant")) else F.col(f"`{c}`") for c, kind in df.dtypes])
