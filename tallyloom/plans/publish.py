"""Publishing partitions: staged, verified, then made current by one small commit.

A published table is a folder of versions of partitions.  A new version of a partition is written
beside the old, its fingerprint is checked against what it must be, and only then does a commit
name it; readers see the old rows or the new, never a mixture, and a failed check leaves the old ones
current.  Of writers at one time those of different partitions all land, and of those of one partition one does.

Beside its rows a version of a partition has a tree of fingerprints: of each document, of each bucket of
documents, and so of the partition.  They are sums, so a patch changes them by what it takes and
brings, a sweep compares sums and reads documents of differing buckets alone, and where a document lies
is known from its bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalars import content_hash
from tallyloom.operators.checks import extra_checks
from tallyloom.operators.fingerprint import add, compare, differing_parts, fingerprint
from tallyloom.plans.commits import CommitLog, ConflictError, Snapshot
from tallyloom.specs import PublishSpec
from tallyloom.staged import staged

#: Buckets of documents in a partition's tree.
BUCKETS = 64


def patch(old: DataFrame, changed: DataFrame, fresh: DataFrame, document: Sequence[str]) -> DataFrame:
    """``old`` less the changed documents, and their fresh rows [STR-11, SNK-08]."""
    kept = old.join(changed.select(*document).distinct(), list(document), "left_anti").select(*old.columns)
    return kept.unionByName(fresh.select(*old.columns))


def touched_partitions(old: DataFrame, changed: DataFrame, fresh: DataFrame, spec: PublishSpec) -> DataFrame:
    """Partitions that changed documents were in or are in now [STR-07, STR-12, JOI-20]."""
    before = old.join(changed.select(*spec.document).distinct(), list(spec.document), "left_semi").select(spec.partition)
    return before.union(fresh.select(spec.partition)).distinct()


def patch_findings(old: DataFrame, changed: DataFrame, fresh: DataFrame, new: DataFrame, spec: PublishSpec) -> DataFrame:
    """(part, metric, a, b) where kept and fresh rows do not add up to the new partition [AGG-08, STR-11]."""
    by = [spec.partition]
    kept = old.join(changed.select(*spec.document).distinct(), list(spec.document), "left_anti")
    want = add([fingerprint(kept, spec.checksum, spec.measures, by), fingerprint(fresh, spec.checksum, spec.measures, by)], by)
    return compare(want, fingerprint(new, spec.checksum, spec.measures, by), by)


def bucketed(rows: DataFrame, document: Sequence[str]) -> DataFrame:
    return rows.withColumn("__bucket", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in document]), F.lit(BUCKETS)).cast("int"))


class Store:
    """A published table at ``path``; ``current()`` reads the newest version, or that of a snapshot."""

    def __init__(self, spark: SparkSession, path: str, spec: PublishSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.log = CommitLog(spark, f"{self.path}/log")

    def snapshot(self, version: int | None = None) -> Snapshot:
        return self.log.snapshot(version)

    def versions(self) -> dict[int, str]:
        """Partition -> folder; one row a partition."""
        return self.snapshot().parts

    def _read(self, kind: str, parts: dict[int, str], buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows, or a level of the tree, of some partitions in one scan."""
        folders = [f"{self.path}/{folder}/{kind}/__part={p}" for p, folder in sorted(parts.items())]
        if kind == "docs":  # bucket by bucket, so only those asked for are opened
            folders = [f"{f}/__bucket={b}" for f, have in zip(folders, self._buckets(parts)) for b in sorted(have if buckets is None else have & {*buckets})]
        return self.spark.read.parquet(*folders) if folders else None

    def _buckets(self, parts: dict[int, str]) -> list[set[int]]:
        """The buckets that each partition has, in order; at most ``BUCKETS`` a partition."""
        there = self._read("buckets", parts)
        have: dict[int, set[int]] = {}
        for r in there.select(self.spec.partition, "bucket").collect() if there is not None else []:
            have.setdefault(r[0], set()).add(r[1])
        return [have.get(p, set()) for p in sorted(parts)]

    def current(self, parts: Iterable[int] | None = None, at: Snapshot | None = None) -> DataFrame | None:
        """Rows of the listed partitions, or of all, in one scan; files hold the partition column too."""
        there = (at or self.snapshot()).parts
        return self._read("all", there if parts is None else {p: f for p, f in there.items() if p in {*parts}})

    def sums(self, at: Snapshot | None = None, parts: Iterable[int] | None = None) -> DataFrame | None:
        """(partition, bucket, n, checksum, ...): the upper level of the tree."""
        there = (at or self.snapshot()).parts
        return self._read("buckets", there if parts is None else {p: f for p, f in there.items() if p in {*parts}})

    def documents(self, asked: DataFrame | None = None, at: Snapshot | None = None) -> DataFrame | None:
        """(partition, document, n, checksum, ...): the lower level, of all documents or of those in the buckets of ``asked``."""
        at = at or self.snapshot()
        if asked is None:
            return self._read("docs", at.parts)
        buckets = [r[0] for r in bucketed(asked, self.spec.document).select("__bucket").distinct().collect()]  # BUCKETS at most
        found = self._read("docs", at.parts, buckets)
        return None if found is None else found.join(asked.select(*self.spec.document).distinct(), list(self.spec.document), "left_semi").select(*found.columns)

    def publish(self, rows: DataFrame, parts: Sequence[int], want: DataFrame | None = None, base: Snapshot | None = None, allows=None) -> dict[int, str]:
        """Replaces the listed partitions by ``rows``; returns what became of each [SNK-07, STR-12, STR-13, STR-14].

        ``want`` is the fingerprint the rows must have, by partition; ``base`` the snapshot they were made from.  Rows outside the list or without
        a partition, failed checks or a wrong fingerprint raise ValueError and change nothing.  A
        partition that already equals its rows is skipped; an empty one follows the policy.  Where
        another publisher has changed one of the partitions since ``base``, ConflictError is raised and nothing changed.
        """
        spec, by = self.spec, [self.spec.partition]
        base = base or self.snapshot()
        outside = rows.where(F.col(spec.partition).isNull() | ~F.col(spec.partition).isin(*parts)).select(spec.partition).distinct().take(3)
        if outside:
            raise ValueError(f"rows of other partitions: {[r[0] for r in outside]}")
        folder = f"data/{uuid.uuid4().hex}"
        own = f"{self.path}/{folder}"
        rows.withColumn("__part", F.col(spec.partition)).hint("rebalance", "__part").write.partitionBy("__part").option("compression", "zstd").parquet(f"{own}/all")
        staged_rows = self.spark.read.schema(rows.schema).parquet(f"{own}/all").select(*rows.columns)
        have = add([self._grow(staged_rows, own).drop("bucket", "__part")], by)
        if want is not None and (bad := compare(want, have, by).take(5)):
            raise ValueError(f"fingerprints differ: {bad}")
        if spec.business_key or spec.not_zero or spec.not_empty:
            unique = [spec.business_key] if spec.business_key else []
            if bad := extra_checks(staged_rows, unique, spec.not_zero, spec.not_empty).where("bad > 0").collect():
                raise ValueError(f"checks failed: {[tuple(r) for r in bad]}")
        filled = {r[0] for r in have.select(spec.partition).collect()}
        if (empty := sorted(set(parts) - filled)) and spec.on_empty == "fail":
            raise ValueError(f"partitions would be empty: {empty}")
        same: set[int] = set()
        if (old := self.sums(base, parts)) is not None:
            differing = {r[0] for r in compare(add([old.drop("bucket")], by), have, by).select(spec.partition).distinct().collect()}
            same = filled - differing
        done = {p: "unchanged" if p in same else "published" if p in filled else "cleared" for p in parts}
        moved = {p: folder if s == "published" else "" for p, s in done.items() if s != "unchanged"}
        if moved:
            self.log.commit(base, moved, parts, allows)
        return done

    def _grow(self, rows: DataFrame, own: str) -> DataFrame:
        """Writes the tree of ``rows``, each level from the one below; returns the upper one."""
        spec = self.spec
        tagged = bucketed(rows.withColumn("__part", F.col(spec.partition)), spec.document)
        leaves = fingerprint(tagged, spec.checksum, spec.measures, ["__part", "__bucket", spec.partition, *spec.document])
        leaves.hint("rebalance", "__part").write.partitionBy("__part", "__bucket").option("compression", "zstd").parquet(f"{own}/docs")
        docs = self.spark.read.schema(leaves.schema).parquet(f"{own}/docs")
        sums = add([docs.withColumn("bucket", F.col("__bucket")).drop("__bucket", *spec.document)], ["__part", spec.partition, "bucket"])
        sums.repartition(1, "__part").write.partitionBy("__part").option("compression", "zstd").parquet(f"{own}/buckets")
        return self.spark.read.schema(sums.schema).parquet(f"{own}/buckets")

    def apply(self, changed: DataFrame, fresh: DataFrame) -> dict[int, str]:
        """A document patch of every partition it touches [STR-11].

        Where the changed documents lie is read from their buckets of the tree, and what the patched
        partitions must come to is their old sums less the documents that go and more the fresh ones, so
        rows are read of touched partitions alone.  A publisher that came in between
        with one of the changed documents raises ConflictError, as does one of the same partitions.
        """
        spec, by, base = self.spec, [self.spec.partition], self.snapshot()
        old = self.current(at=base)
        if old is None:
            raise ValueError("nothing is published yet; rebuild first")
        changed = changed.select(*spec.document).distinct()
        leaves = self.documents(changed, base)
        gone = staged(fingerprint(fresh.limit(0), spec.checksum, spec.measures, [*by, *spec.document]) if leaves is None else leaves.select(*by, *spec.document, *[c for c in leaves.columns if c not in (*by, *spec.document)]), "gone")
        parts = [r[0] for r in gone.select(spec.partition).union(fresh.select(spec.partition)).distinct().collect()]  # a row a touched partition
        mine = self.current(parts, base)
        mine = old.limit(0) if mine is None else mine
        took = gone.select(*by, *[(-F.col(c)).alias(c) for c in gone.columns if c not in (*by, *spec.document)])
        sums = self.sums(base, parts)
        pieces = [took, fingerprint(fresh, spec.checksum, spec.measures, by), *([sums.drop("bucket")] if sums is not None else [])]
        want = add(pieces, by).where("n <> 0")

        def allows(theirs: dict) -> bool:
            other = self.documents(changed, Snapshot(0, {p: f for p, f in theirs.items() if f}))
            return other is None or other.isEmpty()

        return self.publish(patch(mine, changed, fresh, spec.document), parts, want, base, allows)

    def sweep(self, source: DataFrame) -> DataFrame:
        """(partition) of those that differ between the source and what is published [STR-09]; of the store only sums are read."""
        spec, by = self.spec, [self.spec.partition]
        mine = fingerprint(source, spec.checksum, spec.measures, by)
        sums = self.sums()
        return differing_parts(mine, mine.limit(0) if sums is None else add([sums.drop("bucket")], by), by)

    def differing_documents(self, source: DataFrame) -> DataFrame:
        """(partition, document, state) of documents that are new at the source, changed, or gone from it [CHK-05, CHK-06].

        Sums of buckets are compared first; documents are compared in buckets that differ, and of the store only those are read.
        """
        spec, at = self.spec, self.snapshot()
        by = [spec.partition, "bucket"]
        tagged = bucketed(source, spec.document).withColumnRenamed("__bucket", "bucket")
        mine = staged(fingerprint(tagged, spec.checksum, spec.measures, by), "source-sums")
        sums = self.sums(at)
        differ = staged(differing_parts(mine, mine.limit(0) if sums is None else sums.select(*mine.columns), by), "differing")
        open_ = {}
        for r in differ.collect():  # BUCKETS a partition at most
            open_.setdefault(r[0], set()).add(r[1])
        folders = [f"{self.path}/{at.parts[p]}/docs/__part={p}/__bucket={b}" for p, have in zip(sorted(at.parts), self._buckets(at.parts)) for b in sorted(have & open_.get(p, set()))]
        names = [spec.partition, *spec.document]
        left = fingerprint(tagged.join(differ, by, "left_semi"), spec.checksum, spec.measures, names)
        right = self.spark.read.parquet(*folders) if folders else left.limit(0)
        found = compare(left, right, names)
        lacks = lambda side: F.bool_or((F.col("metric") == "n") & F.col(side).isNull())
        return found.groupBy(*names).agg(F.when(lacks("b"), "new").when(lacks("a"), "deleted").otherwise("changed").alias("state"))


def promote(shadow: Store, live: Store) -> str:
    """Makes a shadow table's content the live one's, and proves it by the hash of all columns [SNK-19].

    Other columns or another partition raise ValueError, and so does a live table that holds anything
    else; one that holds the same is left alone, so a promotion may be repeated after a failure.
    """
    rows, have = shadow.current(), live.current()
    if rows is None:
        raise ValueError("the shadow table is empty")
    if shadow.spec.partition != live.spec.partition or shadow.spec.business_key != live.spec.business_key:
        raise ValueError("the tables differ in partition or key")
    if have is not None:
        if sorted(have.dtypes) != sorted(rows.dtypes):
            raise ValueError("the tables differ in their columns")
        if content(have) != content(rows):
            raise ValueError("the live table holds other rows")
        return "unchanged"
    live.publish(rows, sorted(shadow.versions()))
    if content(live.current()) != content(rows):
        raise ValueError("the live table differs after promotion")
    return "promoted"


def content(rows: DataFrame) -> tuple:
    """(rows, sum of the hashes of all columns in the order of their names)."""
    return tuple(rows.agg(F.count("*"), F.sum(content_hash(*[F.col(c) for c in sorted(rows.columns)]))).first())


def due_mode(last_sweep: Column, last_hot: Column, now: Column) -> Column:
    """sweep once a day from 03:00 on, hot once an hour, else patch [STR-10]."""
    day = F.date_trunc("day", now) + F.expr("INTERVAL 3 HOURS")
    sweep = (now >= day) & (F.coalesce(last_sweep, F.lit("1970-01-01").cast("timestamp")) < day)
    hot = F.coalesce(last_hot, F.lit("1970-01-01").cast("timestamp")) <= now - F.expr("INTERVAL 1 HOUR")
    return F.when(sweep, "sweep").when(hot, "hot").otherwise("patch")
