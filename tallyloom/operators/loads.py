"""Batch loads put together from the operators: whole periods, listed documents, links after a load, feeds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import ref_type, ref_uid
from tallyloom.operators.audit import is_vanished
from tallyloom.operators.integrity import require
from tallyloom.operators.keys import fill_links, issue_ids, repair_links
from tallyloom.operators.merge import last_by, load
from tallyloom.plans.commits import ConflictError
from tallyloom.specs import TargetSpec
from tallyloom.staged import staged


def audit_stamps(rows: DataFrame, key: str, loaded_at: Column, signals: DataFrame | None = None, snapshot: Column | None = None) -> DataFrame:
    """Rows with ``etl_updated_at``, and where there are signals ``retail_updated_at`` of each key and one ``retail_snapshot_at`` [PRJ-10].

    Without a snapshot that one mark is the latest signal among the rows; without signals and
    snapshot neither mark is a column of the result, so a load keeps the marks that rows have.
    """
    out = rows.withColumn("etl_updated_at", loaded_at)
    if signals is not None:
        latest = signals.groupBy(F.col("uid").alias("__uid")).agg(F.max("updated_at").alias("retail_updated_at"))
        out = out.join(latest, F.lower(F.col(key).cast("string")) == F.col("__uid"), "left").drop("__uid")
        if snapshot is None:
            top = out.agg(F.max("retail_updated_at").alias("retail_snapshot_at"))  # one row
            return out.join(F.broadcast(top))
    return out if snapshot is None else out.withColumn("retail_snapshot_at", snapshot)


def full_period(targets: Mapping[str, DataFrame], frames: Mapping[str, DataFrame], specs: Mapping[str, TargetSpec], key: str, snapshot: Column, loaded_at: Column, validate: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every target after a whole period's rows, under one snapshot stamp [STR-04].

    ``frames`` are the rows extracted for the period.  With ``validate`` its findings are required to
    be clean, else ValueError is raised and no target is returned.
    """
    out = {}
    for name, rows in frames.items():
        marked = audit_stamps(rows, key, loaded_at, snapshot=snapshot)
        marked = marked.withColumn("retail_updated_at", snapshot) if "retail_updated_at" in targets[name].columns else marked
        spec = specs[name]
        out[name] = load(targets[name], marked.select(*[c for c in targets[name].columns if c in marked.columns]), spec.mode, spec.keys)
    if validate is not None:
        require(validate(out))
    return out


def documents(targets: Mapping[str, DataFrame], frames: Mapping[str, DataFrame], specs: Mapping[str, TargetSpec], asked: DataFrame, key: str, loaded_at: Column, signals: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every target after the rows of the asked documents alone; without signals no mark moves [STR-06].

    So a reload of documents leaves the watermark where it is: rows keep their mark, new ones have none.
    """
    out = {}
    for name, rows in frames.items():
        mine = rows.join(asked.select(key).distinct(), key, "left_semi")
        marked = audit_stamps(mine, key, loaded_at, signals)
        spec = specs[name]
        out[name] = load(targets[name], marked.select(*[c for c in targets[name].columns if c in marked.columns]), spec.mode, spec.keys)
    return out


def post_load(
    fact: DataFrame, header: DataFrame, on: Mapping[str, str], fk: str, dims: Mapping[str, DataFrame], registers: Mapping[str, DataFrame], *, now: Column,
    refs: str = "raw_refs", stamp: str = "etl_updated_at", recent: str = "INTERVAL 60 MINUTES", older: str = "INTERVAL 30 MINUTES",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact and its dimensions after the links of a load are set [KEY-09].

    In this order: missing links to the header, and wrong ones where the header was loaded lately;
    for each of ``dims`` (reference -> guid, id, is_stub) stubs of unknown references and the column
    ``{reference}_id``; for each of ``registers`` (reference -> uid, code, id) the same column by type
    and uid, null outside its history; then lines that their document's last load did not touch go.
    Run again when more documents have come, it resolves what was late.
    """
    out = repair_links(fill_links(fact, header, dict(on), fk), header, dict(on), fk, F.col(stamp) >= now - F.expr(recent))
    grown: dict[str, DataFrame] = {}
    for name, dim in dims.items():
        guid = ref_uid(F.col(refs), name)
        unknown = out.where(F.col(f"{name}_id").isNull()).select(guid.alias("guid"))
        grown[name] = staged(issue_ids(dim, unknown, ["guid"], stub=F.lit(True)), "grown")
        out = fill_links(out.withColumn("__asked", guid), grown[name], {"__asked": "guid"}, f"{name}_id").drop("__asked")
    for name, register in registers.items():
        out = out.withColumns({"__asked": ref_uid(F.col(refs), name), "__asked_type": ref_type(F.col(refs), name).try_cast("int")})
        out = fill_links(out, register, {"__asked": "uid", "__asked_type": "code"}, f"{name}_id").drop("__asked", "__asked_type")
    sides = header.groupBy(F.col("id").alias("__header")).agg(F.max(stamp).alias("__touched"))
    gone = F.coalesce(is_vanished(F.col(stamp), F.col("__touched"), now, older, recent), F.lit(False))
    return out.join(sides, F.col(fk) == F.col("__header"), "left").where(~gone).drop("__header", "__touched"), grown


def feed(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A feed in place of all rows [SNK-15]: the last of each key in file order, the columns that the target knows, null where the feed lacks one."""
    last = last_by(rows, keys, order)
    return target.limit(0).unionByName(last.select(*[c for c in last.columns if c in target.columns]), allowMissingColumns=True)


def rebuild(run: Callable[[], object], findings: Callable[[], DataFrame], unequal: Callable[[], DataFrame], retries: int = 2, race: type[Exception] | tuple[type[Exception], ...] = (BlockingIOError, ConflictError)) -> object:
    """Loads, validates, reconciles [PIP-08]: only a lost race, such as with another publisher of the same partitions, is tried again, and the load succeeds only if nothing is found."""
    for attempt in range(retries + 1):
        try:
            done = run()
            break
        except race:
            if attempt == retries:
                raise
    require(findings())
    if bad := unequal().take(5):
        raise ValueError(f"does not reconcile: {[tuple(r) for r in bad]}")
    return done
