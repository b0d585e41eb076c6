"""Integrity and reconciliation checks, each a small table of findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.scalars import deviation, is_empty_ref

#: Types that may widen into others.
WIDER = {"smallint": ("int", "bigint"), "int": ("bigint",), "float": ("double",), "date": ("timestamp",)}


def counts_by(df: DataFrame, checks: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """How many rows meet each condition, in one pass [AGG-12]."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in checks.items()])


def extra_checks(df: DataFrame, unique: Sequence[Sequence[str]] = (), not_zero: Sequence[str] = (), not_empty: Sequence[str] = ()) -> DataFrame:
    """(check, bad): configured checks, all of which must be 0 [CHK-02, CHK-01]."""
    conditions = {f"zero:{c}": F.coalesce(F.col(c) == 0, F.lit(True)) for c in not_zero} | {f"empty:{c}": is_empty_ref(F.col(c).cast("string")) for c in not_empty}
    frames = []
    if conditions:
        one = counts_by(df, conditions)
        frames.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("bad")) for n in conditions])).alias("x")).select("x.*"))
    for keys in unique:
        extra = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        frames.append(extra.agg(F.lit(f"unique:{','.join(keys)}").alias("check"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("bad")))
    return reduce(DataFrame.unionByName, frames)


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Children whose set link finds no parent [JOI-13, JOI-22]."""
    linked = child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on]))
    side = parent.select(*[F.col(p).alias(f"__{p}") for p in on.values()])
    return linked.join(side, [F.col(c) == F.col(f"__{p}") for c, p in on.items()], "left_anti")


def childless(parent: DataFrame, child: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Parents without a child [JOI-13]."""
    return orphans(parent, child, {p: c for c, p in on.items()})


def mismatched(child: DataFrame, parent: DataFrame, link: str, parent_id: str, natural: Mapping[str, str]) -> DataFrame:
    """Children linked to a parent whose natural key is another one [JOI-14]."""
    side = parent.select(F.col(parent_id).alias("__id"), *[F.col(p).alias(f"__{p}") for p in natural.values()])
    wrong = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{p}")) for c, p in natural.items()])
    return child.join(side, F.col(link) == F.col("__id")).where(wrong).select(*child.columns)


def coverage(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Both sides' measures by key, 0 where a side has none [JOI-15]."""
    left, right = (df.select(*[F.col(k).alias(f"{s}_{k}") for k in keys], *[F.col(m).alias(f"{m}_{s}") for m in measures]) for s, df in (("a", a), ("b", b)))
    joined = left.join(right, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys], "full_outer")
    return joined.select(*[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys], *[F.coalesce(F.col(f"{m}_{s}"), F.lit(0)).alias(f"{m}_{s}") for m in measures for s in "ab"])


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float = 0.01, open_key: Column | None = None) -> DataFrame:
    """Coverage, differences and a verdict: OK, PARTIAL for a part still open, else DIFF [CHK-13, CHK-14]."""
    both = coverage(a, b, keys, measures)
    both = both.withColumns({f"{m}_delta": F.col(f"{m}_a") - F.col(f"{m}_b") for m in measures})
    bad = reduce(lambda x, y: x | y, [F.abs(F.col(f"{m}_delta")) > tolerance for m in measures])
    verdict = F.when(open_key, "PARTIAL") if open_key is not None else F.when(F.lit(False), "")
    return both.withColumn("verdict", verdict.when(bad, "DIFF").otherwise("OK"))


def reconcile_status(cells: DataFrame, previous: DataFrame, keys: Sequence[str], now: Column, margin: str = "INTERVAL 15 MINUTES") -> DataFrame:
    """PASS, WAIT or FAIL for each cell, with the time since which it differs [CHK-10, SCL-32].

    ``cells`` has a and b; a difference waits for the margin before it fails.  Equal again is PASS, and
    the time is forgotten.
    """
    before = previous.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("since").alias("__since"))
    joined = cells.join(before, [F.col(k) == F.col(f"__{k}") for k in keys], "left").withColumn("diff_pct", deviation(F.col("a"), F.col("b")))
    since = F.when(F.col("diff_pct") > 0, F.coalesce("__since", now))
    status = F.when(F.col("diff_pct") == 0, "PASS").when(F.col("since") > now - F.expr(margin), "WAIT").otherwise("FAIL")
    return joined.withColumn("since", since).withColumn("status", status).select(*keys, "diff_pct", "since", "status")


def schema_changes(have: StructType, want: StructType) -> list[tuple[str, str]]:
    """(column, change): missing, extra, widened or narrowed [CHK-21, CHK-22]; equal schemas give none."""
    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (have, want))
    out = [(c, "missing") for c in b if c not in a] + [(c, "extra") for c in a if c not in b]
    for c in a:
        if c in b and a[c] != b[c]:
            out.append((c, "widened" if b[c] in WIDER.get(a[c], ()) or b[c] == "string" else "narrowed"))
    return sorted(out)


def summary(tables: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """(name, n_source, n_target, n_duplicate, verdict) of each (source, target, key) [CHK-11, CHK-12].

    Each target is grouped by its key once; its rows and surplus rows are sums over the groups.
    """
    frames = []
    for name, (source, target, keys) in tables.items():
        groups = target.groupBy(*keys).agg(F.count("*").alias("n"))
        held = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_target"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate"))
        frames.append(source.agg(F.count("*").alias("n_source")).join(held).withColumn("name", F.lit(name)))
    verdict = F.when(F.col("n_duplicate") > 0, "DUPLICATES").when(F.col("n_source") != F.col("n_target"), "DIFF").otherwise("OK")
    return reduce(DataFrame.unionByName, frames).select("name", "n_source", "n_target", "n_duplicate", verdict.alias("verdict"))
