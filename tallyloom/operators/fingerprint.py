"""Fingerprints: sums that tell whether two sets of rows are equal, and add up over parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import canonical, metric


def row_sum(columns: Sequence[str]) -> Column:
    """The first 32 bits of the MD5 of the row's canonical text."""
    return F.conv(F.substring(F.md5(canonical(*[F.col(c) for c in columns])), 1, 8), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, checksum: Sequence[str], measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n, checksum, and for each measure its sum and sum of squares; by partition or document if asked [AGG-05, AGG-06, AGG-07].

    All aggregates are sums, so they combine map-side and add up over disjoint parts.
    """
    sums = [F.count("*").alias("n"), F.sum(row_sum(checksum)).alias("checksum")]
    for m in measures:
        v = metric(F.col(m)).cast("decimal(18,4)")
        sums += [F.sum(v).alias(f"sum_{m}"), F.sum(v * v).alias(f"sq_{m}")]
    return df.groupBy(*by).agg(*sums)


def add(parts: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """Fingerprints of disjoint parts added up [AGG-08]."""
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in both.columns if c not in by])


def compare(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """(keys, metric, a, b) of what differs; a part on one side alone differs in everything [CHK-03, CHK-05, STR-09]."""
    names = [c for c in a.columns if c not in by]
    left, right = (df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns]) for s, df in (("a", a), ("b", b)))
    joined = left.join(right, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in by], "full_outer")
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"a_{n}").cast("decimal(38,8)").alias("a"), F.col(f"b_{n}").cast("decimal(38,8)").alias("b")) for n in names])
    return joined.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in by], F.explode(pairs).alias("x")).select(*by, "x.*").where(~F.col("a").eqNullSafe(F.col("b")))


def differing_parts(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    return compare(a, b, by).select(*by).distinct()


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of several rows, and how many [AGG-09, AGG-10]; Spark groups them by hashed partitions of bounded size."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def open_partition_diff(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """(keys, state): documents new at the source, changed, or gone from it, from document fingerprints [CHK-06]."""
    left, right = (df.select(*[F.col(k).alias(f"{s}_{k}") for k in by], F.col("n").alias(f"{s}_n"), F.col("checksum").alias(f"{s}_c")) for s, df in (("a", source), ("b", target)))
    joined = left.join(right, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in by], "full_outer")
    state = F.when(F.col("b_n").isNull(), "new").when(F.col("a_n").isNull(), "deleted").when((F.col("a_n") != F.col("b_n")) | (F.col("a_c") != F.col("b_c")), "changed")
    return joined.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in by], state.alias("state")).where("state is not null")
