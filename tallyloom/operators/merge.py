"""Loads as pure functions: (target, source) -> new target.  Writing the result is the caller's."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _equal(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in keys])


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool = False) -> DataFrame:
    """The last row, or the first, of each key in a total order [WIN-03, WIN-04]."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() if first else F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keyed(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all given, and the rest, whose keys match nothing."""
    whole = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    return rows.where(whole), rows.where(~whole)


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """[SNK-01]"""
    return target.unionByName(source, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, guard: bool = False) -> DataFrame:
    """Rows of equal keys take the source's columns and keep their others; new keys are added [SNK-02, SNK-03].

    Of several source rows of a key the last in ``order`` wins.  Null keys match nothing, so all rows of
    one are added, as many as there are.  A source of
    keys alone changes no row.  With ``guard`` rows equal in every given column are left as they are [SNK-13].
    """
    whole, loose = keyed(source, keys)
    rows = (last_by(whole, keys, order) if order else whole.dropDuplicates(list(keys))).unionByName(loose)
    rows = rows.drop(*[c for c in order or () if c not in target.columns])
    given = [c for c in rows.columns if c in target.columns and c not in keys]
    rows = rows.withColumn("__new", F.lit(True))
    joined = target.withColumn("__old", F.lit(True)).alias("t").join(rows.alias("s"), _equal("t", "s", keys), "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in given], F.lit(False)) if guard else F.lit(True)
    take = F.col("s.__new") & (F.col("t.__old").isNull() | differs)

    def pick(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c)
        return (F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in given else F.col(f"t.{c}")).alias(c)

    return joined.select(*[pick(c) for c in target.columns])


def replace(target: DataFrame, source: DataFrame, where: str | None = None) -> DataFrame:
    """All rows, or those that meet ``where``, give way to the source; an empty source changes nothing [SNK-04]."""
    if source.isEmpty():
        return target
    source = source.select(*target.columns)
    return source if where is None else target.where(~F.coalesce(F.expr(where), F.lit(False))).unionByName(source)


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Documents in the source replace theirs in the target; source rows of null keys are added as they are [SNK-05]."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns).unionByName(source.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Only keys that the target lacks are added, of several rows of a key the first in ``order`` [SNK-09]; all rows of a null key are."""
    whole, loose = keyed(source, keys)
    rows = whole.dropDuplicates(list(keys)) if order is None else last_by(whole, keys, order, first=True)
    fresh = rows.join(target, list(keys), "left_anti").select(*source.columns).unionByName(loose)
    return target.unionByName(fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True)


def update_if_different(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str], stub: str | None = None, mark: Column | None = None, mark_column: str | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """The target with changed rows updated, and ``touched``; a touched row is no stub any more [SNK-10, SNK-11, STR-22].

    ``mark`` may be a column of the source or a literal; where it is null the old mark stays.  Of several
    source rows of a key the last in ``order`` counts.
    """
    side = (source.dropDuplicates([key]) if order is None else last_by(source, [key], order)).select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns], *([mark.alias("__mark")] if mark is not None else []))
    joined = target.join(side, F.col(key) == F.col("__key"), "left")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns], F.lit(False))
    if stub:
        differs = differs | F.coalesce(F.col(stub), F.lit(False))
    touched = F.col("__key").isNotNull() & differs
    new = {c: F.when(F.col("touched"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    if stub:
        new[stub] = F.when(F.col("touched"), F.lit(False)).otherwise(F.col(stub))
    if mark_column:
        new[mark_column] = F.when(F.col("touched"), F.coalesce("__mark", mark_column)).otherwise(F.col(mark_column))
    joined = joined.withColumn("touched", touched)
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in target.columns], "touched")


def stamp(target: DataFrame, column: str, value: Column) -> DataFrame:
    """One mark on every row where it differs [SNK-12]."""
    return target.withColumn(column, F.when(F.col(column).eqNullSafe(value), F.col(column)).otherwise(value))


def append_new_periods(target: DataFrame, source: DataFrame, period: str) -> DataFrame:
    """Rows of periods, trimmed, that the target has not yet [SNK-14]."""
    had = target.select(F.trim(period).alias("__p")).distinct()
    return target.unionByName(source.join(had, F.trim(period) == F.col("__p"), "left_anti"))


def reload_period(headers: DataFrame, lines: DataFrame, new_headers: DataFrame, new_lines: DataFrame, key: str, period: str, start, end) -> tuple[DataFrame, DataFrame]:
    """Documents of ``[start, end)`` go with their lines, and the new ones come [SNK-16]."""
    gone = headers.where((F.col(period) >= F.lit(start).cast("timestamp")) & (F.col(period) < F.lit(end).cast("timestamp"))).select(key).distinct()
    return headers.join(gone, key, "left_anti").unionByName(new_headers), lines.join(gone, key, "left_anti").unionByName(new_lines)


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Documents that vanished at the source go [SNK-17]."""
    return target.join(keys.select(key).distinct(), key, "left_anti").select(*target.columns)


def roll_back_incomplete(headers: DataFrame, lines: DataFrame, run_headers: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Headers of a failed run that have no line go, and so do the run's lines [SNK-18]."""
    bare = run_headers.join(lines, key, "left_anti").select(key)
    return headers.join(bare, key, "left_anti").select(*headers.columns), lines.join(run_headers.select(key), key, "left_anti").select(*lines.columns)


def load(target: DataFrame, source: DataFrame, mode: str, keys: Sequence[str] = (), where: str | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """By mode; an unknown mode, or a mode that lacks its keys, raises ValueError [SNK-06].

    Of several source rows of a key an upsert takes the last in ``order``; without one, that is one of
    those that are largest in all their columns in turn, so a rerun takes the same.
    """
    if mode in ("upsert", "delete_insert") and not keys:
        raise ValueError(f"{mode} needs keys")
    modes = {"insert": lambda: append(target, source), "upsert": lambda: upsert(target, source, keys, order or [c for c in source.columns if c not in keys] or list(keys)), "replace": lambda: replace(target, source, where), "delete_insert": lambda: delete_insert(target, source, keys)}
    if mode not in modes:
        raise ValueError(f"unknown load mode {mode}")
    return modes[mode]()
