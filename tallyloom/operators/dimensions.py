"""Dimensions kept current: changed references, new ones, and stubs filled batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import is_complete
from tallyloom.operators.audit import next_batch
from tallyloom.operators.keys import numbered
from tallyloom.operators.merge import insert_missing, last_by, stamp, update_if_different


def incremental(dim: DataFrame, source: DataFrame, key: str, columns: Sequence[str], mark: str, register: bool = True) -> DataFrame:
    """The dimension after what changed at the source since its own latest mark [STR-16, STR-18, STR-19].

    Existing rows change where a column differs, and take the source row's mark; with ``register`` new
    keys follow, ids going on from the largest in key order.  A dimension without a mark takes all.
    """
    since = dim.agg(F.max(mark).alias("__since"))
    changed = source.join(F.broadcast(since)).where(F.col("__since").isNull() | (F.col(mark) > F.col("__since"))).drop("__since")
    updated = update_if_different(dim, changed, key, columns, "is_stub", F.col(mark), mark, order=[mark, *columns]).drop("touched")
    if not register:
        return updated
    fresh = last_by(changed.where(F.col(key).isNotNull()), [key], [mark, *columns]).join(dim, key, "left_anti")
    top = dim.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__top"))
    new = fresh.join(numbered(fresh, [key], "__n"), key).join(F.broadcast(top))
    return updated.unionByName(new.select(key, *columns, mark, (F.col("__n") + F.col("__top")).cast(dim.schema["id"].dataType).alias("id"), F.lit(False).alias("is_stub")), allowMissingColumns=True)


def full_load(dim: DataFrame, source: DataFrame, key: str, columns: Sequence[str], empty: str) -> DataFrame:
    """An empty dimension filled with every reference of the source but the empty one, ids in key order [SRC-14]; one that has rows stays."""
    if not dim.isEmpty():
        return dim
    rows = source.where(F.col(key).isNotNull() & (F.col(key) != empty))
    first = last_by(rows, [key], [*columns])
    new = first.join(numbered(first, [key], "__n"), key)
    return insert_missing(dim, new.select(key, *columns, F.col("__n").cast(dim.schema["id"].dataType).alias("id"), F.lit(False).alias("is_stub")), [key])


def by_mode(dim: DataFrame, source: DataFrame, mode: str, key: str, columns: Sequence[str], mark: str, empty: str = "", snapshot: Column | None = None) -> DataFrame:
    """The dimension after a load of one mode; an unknown mode raises ValueError [STR-18].

    ``initial`` fills an empty dimension; ``reload`` takes every row of known keys; ``register`` and
    ``update`` take what changed since the mark, with new keys and without.  With ``snapshot`` all
    rows then bear that one mark, else each bears its source row's [STR-19].
    """
    modes = {
        "initial": lambda: full_load(dim, source, key, columns, empty),
        "reload": lambda: update_if_different(dim, source, key, columns, "is_stub", F.col(mark), mark, order=[mark, *columns]).drop("touched"),
        "register": lambda: incremental(dim, source, key, columns, mark),
        "update": lambda: incremental(dim, source, key, columns, mark, register=False),
    }
    if mode not in modes:
        raise ValueError(f"unknown dimension mode {mode}")
    out = modes[mode]()
    return out if snapshot is None else stamp(out, mark, snapshot)


def stub_pass(dim: DataFrame, source: DataFrame, key: str, columns: Sequence[str], shown: Sequence[str], cursor: int, n: int) -> DataFrame:
    """The dimension after ``n`` stubs on from the cursor were looked up at the source [STR-17, STR-22, SRC-15, SCL-39].

    Found attributes are taken; a row is no stub any more once one of its shown columns has text.
    """
    asked = next_batch(dim.where("is_stub"), "id", cursor, n).select(key)
    found = source.join(asked, key, "left_semi").dropDuplicates([key]).select(key, *[F.col(c).alias(f"__{c}") for c in columns], is_complete([F.col(c) for c in shown]).alias("__done"))
    joined = dim.join(found, key, "left")
    new = {c: F.when(F.col("__done").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}
    new["is_stub"] = F.col("is_stub") & ~F.coalesce("__done", F.lit(False))
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in dim.columns])


def vanished(dim: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys that the source no longer has: reported, never dropped silently [SET-07]."""
    return dim.select(key).join(source, key, "left_anti")
