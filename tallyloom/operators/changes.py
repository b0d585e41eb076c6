"""What changed: signal tables, late arrivals, readiness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import norm_key

OVERLAP, SKEW, LOOK_BACK = "INTERVAL 5 MINUTES", "INTERVAL 5 SECONDS", "INTERVAL 15 DAYS"


def signals(sources: Sequence[tuple[DataFrame, str, str]], start=None, end=None, zone: str | None = None, where: str | None = None) -> DataFrame:
    """(uid, updated_at): the latest signal of each key over all sources, in ``[start, end)`` [SRC-12, SET-02, AGG-16].

    A source is (table, key column, time column).  Null keys are skipped; ``zone`` turns UTC into local time.
    """
    frames = []
    for df, key, at in sources:
        if where:
            df = df.where(F.expr(where))
        df = df.select(F.lower(F.col(key).cast("string")).alias("uid"), F.col(at).alias("updated_at")).where("uid is not null")
        if start is not None:
            df = df.where(F.col("updated_at") >= F.lit(start).cast("timestamp"))
        if end is not None:
            df = df.where(F.col("updated_at") < F.lit(end).cast("timestamp"))
        frames.append(df)
    latest = reduce(DataFrame.unionByName, frames).groupBy("uid").agg(F.max("updated_at").alias("updated_at"))
    return latest if zone is None else latest.withColumn("updated_at", F.from_utc_timestamp("updated_at", zone))


def signal_for(keys: DataFrame, latest: DataFrame) -> DataFrame:
    """Every listed key with its latest signal, null where it has none [SRC-13]."""
    return keys.select("uid").distinct().join(latest.select("uid", "updated_at"), "uid", "left")


def window_bounds(watermark: Column, now: Column) -> tuple[Column, Column]:
    """From the watermark less an overlap to now less the clock's skew [STR-01]."""
    return watermark - F.expr(OVERLAP), now - F.expr(SKEW)


def clamp(signalled: DataFrame, end: Column, upper: Column | None) -> tuple[DataFrame, Column]:
    """Signals before the upper bound, and the window's end, which it holds back too [FLT-11]."""
    return (signalled, end) if upper is None else (signalled.where(F.col("updated_at") < upper), F.least(end, upper))


def late(signalled: DataFrame, warehouse: DataFrame, key: str, since: Column) -> DataFrame:
    """Signals since ``since`` whose key the warehouse lacks; they stay until they arrive or age out [STR-02, JOI-11]."""
    return signalled.where(F.col("updated_at") >= since).join(warehouse.select(F.col(key).cast("string").alias("uid")).distinct(), "uid", "left_anti")


def changed(window: DataFrame, tail: DataFrame) -> DataFrame:
    """Window and tail signals, the latest of each key [SET-06, WIN-03]."""
    return window.select("uid", "updated_at").unionByName(tail.select("uid", "updated_at")).groupBy("uid").agg(F.max("updated_at").alias("updated_at"))


def classify(candidates: DataFrame, source_keys: DataFrame, deleted_keys: DataFrame | None = None, uuid: bool = False) -> DataFrame:
    """(uid, state): invalid, ready (at the source), deleted, or pending [STR-03, SET-04, JOI-12]."""
    key = norm_key(F.col("uid")) if uuid else F.nullif(F.trim("uid"), F.lit(""))
    rows = candidates.select("uid", key.alias("k")).distinct()
    there = source_keys.select(F.col("uid").alias("s")).distinct()
    rows = rows.join(there, F.col("k") == F.col("s"), "left")
    if deleted_keys is None:
        return rows.select("uid", F.when(F.col("k").isNull(), "invalid").when(F.col("s").isNotNull(), "ready").otherwise("pending").alias("state"))
    rows = rows.join(deleted_keys.select(F.col("uid").alias("g")).distinct(), F.col("k") == F.col("g"), "left")
    return rows.select("uid", F.when(F.col("k").isNull(), "invalid").when(F.col("g").isNotNull(), "deleted").when(F.col("s").isNotNull(), "ready").otherwise("pending").alias("state"))


def missing(asked: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """Keys asked for that did not come back [SET-03, SET-09]."""
    return asked.select(key).distinct().join(returned.select(key).distinct(), key, "left_anti")


def newest(signalled: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest signals, ties by key; each task gives its own n at most [SRT-02, SRT-03]."""
    return signalled.orderBy(F.desc_nulls_last("updated_at"), "uid").limit(n)


def with_unresolved(changes: DataFrame, target: DataFrame, key: str, link: str, at: str, since: Column) -> DataFrame:
    """Changed keys and recent target rows whose link is still 0 [JOI-21]."""
    open_rows = target.where((F.col(link) == 0) & (F.col(at) >= since)).select(key).distinct()
    return changes.select(key).union(open_rows).distinct()


def watermark(frames: Sequence[tuple[DataFrame, str]], default: str) -> DataFrame:
    """One row: the largest time of the first table and column that have one, else ``default`` [AGG-14, AGG-15]."""
    tops = [df.agg(F.max(c).alias(f"t{k}")) for k, (df, c) in enumerate(frames) if c in df.columns]
    one = reduce(lambda a, b: a.join(b), tops)
    return one.select(F.coalesce(*[F.col(c) for c in one.columns], F.lit(default).cast("timestamp")).alias("watermark"))


def affected_partitions(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(part, reason) of the union of tagged partition lists; the first list that names one gives the reason [STR-07]."""
    tagged = [df.select(F.col("part"), F.lit(k).alias("k"), F.lit(reason).alias("reason")) for k, (reason, df) in enumerate(parts)]
    return reduce(DataFrame.unionByName, tagged).groupBy("part").agg(F.min_by("reason", "k").alias("reason"))
