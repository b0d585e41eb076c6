"""Stable surrogate ids and references resolved to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.staged import staged


def numbered(keys: DataFrame, order: Sequence[str], to: str) -> DataFrame:
    """Distinct keys (the columns of ``order``) and ``to`` = 1, 2, 3, ... in their order, without one task holding all.

    The keys are range-partitioned, sorted and written once, each with its part and its place there;
    numbers and offsets both come from what was written, so they belong to the same parts.
    """
    laid = keys.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())  # part << 33 | place
    laid = staged(laid, "numbered").select("*", F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__k"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = laid.groupBy("__part").agg(F.count("*").alias("__n")).withColumn("__before", before).drop("__n")  # a row a part
    return laid.join(F.broadcast(offsets), "__part").select(*order, (F.col("__k") + F.col("__before") + 1).alias(to))


def issue_ids(registry: DataFrame, wanted: DataFrame, keys: Sequence[str], id_col: str = "id", stub: Column | None = None) -> DataFrame:
    """The registry and a row for each new key, ids going on from the largest in key order [KEY-01, KEY-02].

    Old ids never change.  Null keys get none.  ``stub`` is what ``is_stub`` becomes for new rows.
    """
    fresh = wanted.select(*keys).dropna().distinct().join(registry, list(keys), "left_anti")
    top = registry.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("__top"))
    new = numbered(fresh, keys, "__id").join(F.broadcast(top)).select(*keys, (F.col("__id") + F.col("__top")).cast(registry.schema[id_col].dataType).alias(id_col), *([stub.alias("is_stub")] if "is_stub" in registry.columns else []))
    return registry.unionByName(new, allowMissingColumns=True)


def clear_stubs(registry: DataFrame, arrived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose own document has come are stubs no more [KEY-02]."""
    came = arrived.select(*keys).dropna().distinct().withColumn("__came", F.lit(True))
    return registry.join(came, list(keys), "left").withColumn("is_stub", F.col("is_stub") & F.col("__came").isNull()).select(*registry.columns)


def seed(registry: DataFrame, facts: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """Keys of existing facts that the registry lacks, with the ids they have [KEY-03]."""
    have = facts.select(*keys, id_col).dropna().groupBy(*keys).agg(F.min(id_col).alias(id_col))
    return registry.unionByName(have.join(registry, list(keys), "left_anti").select(*keys, id_col), allowMissingColumns=True)


def verify_registry(facts: DataFrame, registry: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """One row of counts: missing keys, other ids, keys of several ids, ids of several keys [KEY-04]."""
    side = registry.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(id_col).alias("__id"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = facts.select(*keys, id_col).distinct().join(side, on, "left").agg(
        F.count_if(F.col("__id").isNull()).alias("missing"), F.count_if(F.col("__id") != F.col(id_col)).alias("other_id"))
    many_ids = registry.groupBy(*keys).agg(F.count_distinct(id_col).alias("n")).where("n > 1").agg(F.count("*").alias("keys_with_many_ids"))
    many_keys = registry.groupBy(id_col).agg(F.count_distinct(*keys).alias("n")).where("n > 1").agg(F.count("*").alias("ids_with_many_keys"))
    return joined.join(many_ids).join(many_keys)


def resolve(df: DataFrame, registry: DataFrame, on: dict[str, str], to: str, id_col: str = "id", default: int | None = 0) -> DataFrame:
    """``to`` = the id of the referenced key, ``default`` where there is none [JOI-07, JOI-08, JOI-09, KEY-05].

    ``on`` maps columns of ``df`` to key columns: one for a dimension, two for a polymorphic link.
    """
    side = registry.select(*[F.col(k).alias(f"__{k}") for k in on.values()], F.col(id_col).alias("__id")).dropDuplicates([f"__{k}" for k in on.values()])
    joined = df.join(side, [F.col(c) == F.col(f"__{k}") for c, k in on.items()], "left")
    value = F.col("__id") if default is None else F.coalesce("__id", F.lit(default))
    return joined.withColumn(to, value).drop("__id", *[f"__{k}" for k in on.values()])


def fill_links(lines: DataFrame, headers: DataFrame, on: dict[str, str], fk: str, id_col: str = "id") -> DataFrame:
    """Only missing links are filled; rerun after each batch it also resolves late ones [JOI-05, JOI-10]."""
    return resolve(lines, headers, on, "__fk", id_col, None).withColumn(fk, F.coalesce(fk, "__fk")).drop("__fk")


def repair_links(lines: DataFrame, headers: DataFrame, on: dict[str, str], fk: str, recent: Column, id_col: str = "id") -> DataFrame:
    """Links that differ from the header's id, where the header was touched lately, are set right [JOI-06].

    ``recent`` is a condition over the header's columns; of several headers of a key the largest id counts.
    """
    marked = headers.select("*", recent.alias("__recent"))
    side = marked.groupBy(*[F.col(k).alias(f"__{k}") for k in on.values()]).agg(F.max(id_col).alias("__id"), F.max_by("__recent", id_col).alias("__recent"))
    joined = lines.join(side, [F.col(c) == F.col(f"__{k}") for c, k in on.items()], "left")
    wrong = F.coalesce((F.col(fk) != F.col("__id")) & F.col("__recent"), F.lit(False))
    return joined.withColumn(fk, F.when(wrong, F.col("__id")).otherwise(F.col(fk))).select(*lines.columns)


def links_of(columns: Sequence[str], dims: Sequence[str], targets: dict[str, str] = {}) -> dict[str, tuple[str, str]]:
    """Which references of a mapping lead where [KEY-06]: name -> ("dim" or "document", table).

    ``raw_refs.x`` leads to ``dim_x``; ``raw_refs.x.uid`` to the register named in ``targets``.  A
    reference whose dimension does not exist raises ValueError.
    """
    out: dict[str, tuple[str, str]] = {}
    for c in columns:
        parts = c.split(".")
        if parts[0] != "raw_refs" or len(parts) < 2 or (len(parts) == 3 and parts[2] != "uid"):
            continue
        name = parts[1]
        if len(parts) == 3:
            out[name] = ("document", targets[name])
        elif f"dim_{name}" in dims:
            out[name] = ("dim", f"dim_{name}")
        else:
            raise ValueError(f"{c} names no dimension")
    return out


def fk_column(columns: Sequence[str], parent: str) -> str | None:
    """``{parent}_id``, or that of the singular, whichever exists [KEY-10]."""
    options = [f"{parent}_id", f"{parent[:-1]}_id" if parent.endswith("s") else f"{parent}_id"]
    return next((c for c in options if c in columns), None)
