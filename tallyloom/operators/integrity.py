"""Integrity of whole tables: findings as (check, bad) rows, proposed repairs, gates and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import ZERO_UUID, is_empty_ref
from tallyloom.operators.checks import extra_checks, orphans
from tallyloom.operators.fingerprint import differing_parts, duplicates, fingerprint
from tallyloom.operators.keys import fill_links, repair_links, verify_registry
from tallyloom.specs import PublishSpec


def finding(rows: DataFrame, check: str) -> DataFrame:
    """One row: how many there are."""
    return rows.agg(F.lit(check).alias("check"), F.count("*").alias("bad"))


def together(findings: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def require(findings: DataFrame) -> None:
    """Raises one ValueError that names every check with something bad [CHK-01]."""
    if bad := findings.where("bad > 0").orderBy("check").collect():  # a row a check
        raise ValueError("; ".join(f"{r.check} = {r.bad}" for r in bad))


def load_suite(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], not_null: Mapping[str, Sequence[str]], links: Mapping[str, Mapping[str, Column]], stamps: Sequence[str] = ("etl_updated_at",)) -> DataFrame:
    """(check, bad) of a finished load; ``require`` turns it into one error [CHK-01].

    A table must have rows, no null in its listed columns and stamps, no key twice, and no link that
    is null where its reference (a condition of the row) is set.  One pass a table, and one grouping.
    """
    found = []
    for name, df in tables.items():
        counts = {f"empty:{name}": (F.count("*") == 0).cast("long")}
        counts |= {f"null:{name}.{c}": F.count_if(F.col(c).isNull()) for c in (*not_null.get(name, ()), *(s for s in stamps if s in df.columns))}
        counts |= {f"unresolved:{name}.{c}": F.count_if(F.col(c).isNull() & wanted) for c, wanted in links.get(name, {}).items()}
        one = df.agg(*[v.alias(n) for n, v in counts.items()])
        found.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("bad")) for n in counts])).alias("x")).select("x.*"))
        if name in keys:
            found.append(finding(duplicates(df, keys[name]), f"twice:{name}"))
    return together(found)


def link_findings(child: DataFrame, parent: DataFrame, on: Mapping[str, str], fk: str, child_keys: Sequence[str], parent_keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """(check, bad) of a child table and its parent [CHK-08]: links that are null though the parent lives or lead nowhere, natural keys twice."""
    ids = parent.select(F.col(id_col).alias("__id"))
    parents = parent.select(*[F.col(p).alias(f"__{p}") for p in on.values()])
    living = child.where(F.col(fk).isNull()).join(parents, [F.col(c) == F.col(f"__{p}") for c, p in on.items()], "left_semi")
    nowhere = child.where(F.col(fk).isNotNull()).join(ids, F.col(fk) == F.col("__id"), "left_anti")
    return together([finding(living, "fk_null_with_parent"), finding(nowhere, "fk_dangling"), finding(duplicates(child, child_keys), "dup_child_nk"), finding(duplicates(parent, parent_keys), "dup_parent_nk")])


def proposed_links(child: DataFrame, parent: DataFrame, on: Mapping[str, str], fk: str, id_col: str = "id") -> DataFrame:
    """Children whose link should be another, with ``proposed`` [CHK-08]; after ``repaired`` there is none.

    Of several parents of a key the largest id is proposed.
    """
    side = parent.groupBy(*[F.col(p).alias(f"__{p}") for p in on.values()]).agg(F.max(id_col).alias("proposed"))
    joined = child.join(side, [F.col(c) == F.col(f"__{p}") for c, p in on.items()])
    return joined.where(~F.col(fk).eqNullSafe(F.col("proposed"))).select(*child.columns, "proposed")


def repaired(child: DataFrame, parent: DataFrame, on: Mapping[str, str], fk: str, id_col: str = "id") -> DataFrame:
    """The children with every proposed link taken [CHK-08]."""
    best = parent.groupBy(*on.values()).agg(F.max(id_col).alias(id_col))
    return repair_links(fill_links(child, best, dict(on), fk, id_col), best, dict(on), fk, F.lit(True), id_col)


def dimension_findings(dim: DataFrame, key: str, stub: str = "is_stub") -> DataFrame:
    """(check, bad) of a dimension: rows still stubs, keys twice [CHK-09]."""
    return together([finding(dim.where(F.col(stub)), "stub_rows"), finding(duplicates(dim, [key]), "dup_key")])


def gate(fact: DataFrame, spec: PublishSpec, parents: Mapping[str, tuple[DataFrame, Mapping[str, str]]], registry: tuple[DataFrame, Sequence[str], str] | None = None) -> DataFrame:
    """(check, bad) that must be all 0 before a table goes live [CHK-07]: keys twice, zeroes, empty references, orphans, ids that differ from the registry's."""
    found = [extra_checks(fact, [spec.business_key], spec.not_zero, spec.not_empty)]
    found += [finding(orphans(fact, parent, on), f"orphan:{name}") for name, (parent, on) in parents.items()]
    if registry is not None:
        have, keys, id_col = registry
        one = verify_registry(fact.select(*keys, id_col), have, keys, id_col)
        found.append(one.select(F.explode(F.array(*[F.struct(F.lit(f"registry:{c}").alias("check"), F.col(c).cast("long").alias("bad")) for c in one.columns])).alias("x")).select("x.*"))
    return together([f.select("check", F.col("bad").cast("long").alias("bad")) for f in found])


def expand_refs(fact: DataFrame, links: Mapping[str, DataFrame], id_col: str = "id", guid: str = "guid") -> DataFrame:
    """Each link's id replaced by its dimension's guid, the zero reference where there is none [JOI-16]."""
    out = fact
    for column, dim in links.items():
        side = dim.select(F.col(id_col).alias("__id"), F.col(guid).alias("__guid")).dropDuplicates(["__id"])
        out = out.join(side, F.col(column) == F.col("__id"), "left").withColumn(column, F.coalesce("__guid", F.lit(ZERO_UUID))).drop("__id", "__guid")
    return out


def members_alike(members: Sequence[tuple[DataFrame, Mapping[str, Column], Mapping[str, Column], Mapping[str, Column]]], keys: Sequence[str], refs: Sequence[str], measures: Sequence[str], part: str) -> DataFrame:
    """Rows of several source members as one table to take a fingerprint of [CHK-04].

    A member is (table, keys, references, measures), each a name to an expression; ``part`` is one of
    its keys' names or of its columns.  A key that a member lacks raises ValueError.  A reference that
    a member lacks is the zero reference, a measure 0; what no member has is left out of the plan.
    """
    refs = [r for r in refs if any(r in m[2] for m in members)]
    measures = [m for m in measures if any(m in x[3] for x in members)]
    frames = []
    for df, own_keys, own_refs, own_measures in members:
        if lacking := [k for k in keys if k not in own_keys]:
            raise ValueError(f"a member lacks the key {', '.join(lacking)}")
        ref = {r: own_refs[r].cast("string") if r in own_refs else F.lit(ZERO_UUID) for r in refs}
        frames.append(df.select(
            F.col(part), *[own_keys[k].cast("string").alias(k) for k in keys], *[F.when(is_empty_ref(c), F.lit(ZERO_UUID)).otherwise(F.lower(c)).alias(r) for r, c in ref.items()],
            *[(own_measures[m] if m in own_measures else F.lit(0)).cast("decimal(18,4)").alias(m) for m in measures],
        ))
    return reduce(DataFrame.unionByName, frames)


def verification(tables: Mapping[str, tuple[DataFrame, DataFrame, PublishSpec]], history: int | None = None, open_parts: Sequence[int] = ()) -> DataFrame:
    """(name, check, bad) over all published tables [CHK-11]: unequal closed and open partitions, keys twice, and the configured checks.

    Partitions before ``history`` are partial by nature and not compared [FLT-12].
    """
    found = []
    for name, (source, target, spec) in tables.items():
        by = [spec.partition]
        a, b = (since_history(df, spec.partition, history) for df in (source, target))
        unequal = differing_parts(fingerprint(a, spec.checksum, spec.measures, by), fingerprint(b, spec.checksum, spec.measures, by), by)
        is_open = F.coalesce(F.col(spec.partition).isin(*open_parts), F.lit(False)) if open_parts else F.lit(False)
        for check, rows in (("closed_unequal", unequal.where(~is_open)), ("open_unequal", unequal.where(is_open))):
            found.append(finding(rows, check).withColumn("name", F.lit(name)))
        found.append(extra_checks(target, [spec.business_key], spec.not_zero, spec.not_empty).withColumn("name", F.lit(name)))
    return together([f.select("name", "check", F.col("bad").cast("long").alias("bad")) for f in found])


def since_history(df: DataFrame, part: str, history: int | None) -> DataFrame:
    """Partitions from the start of full history on [FLT-12]."""
    return df if history is None else df.where(F.col(part) >= history)


def cutover_problems(tables: Mapping[str, tuple[DataFrame, DataFrame, PublishSpec]], hot: Sequence[int], history: int | None = None) -> DataFrame:
    """(name, problem, part) that forbids going over to a shadow table [CHK-23]: it is empty, or a closed month differs from the source."""
    found = []
    for name, (source, shadow, spec) in tables.items():
        empty = shadow.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(name).alias("name"), F.lit("empty").alias("problem"), F.lit(None).cast("int").alias("part"))
        closed = [since_history(df, spec.partition, history).where(~F.col(spec.partition).isin(*hot)) for df in (source, shadow)]
        bad = differing_parts(*[fingerprint(df, spec.checksum, spec.measures, [spec.partition]) for df in closed], [spec.partition])
        found += [empty, bad.select(F.lit(name).alias("name"), F.lit("unequal").alias("problem"), F.col(spec.partition).cast("int").alias("part"))]
    return together(found)
