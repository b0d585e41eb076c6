"""Keyed tables in buckets of key hashes: a load reads and writes the buckets of its own keys.

Rows lie in buckets by a hash of their key, each a folder that a commit names.  A load groups its keys by
bucket, reads only those that it touches, and writes them anew beside the old, so its cost grows with what
it brings and not with the table, and readers of an older version go on undisturbed.  Within a bucket's folder files
carry the least and largest key and a Bloom filter of the keys, so that a lookup of few keys opens few of their pages.  Rows of a null
key match nothing: each load puts its own into a part beside the buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import keys as ids
from tallyloom.operators import merge
from tallyloom.plans.commits import CommitLog, Snapshot
from tallyloom.staged import staged


class BucketTable:
    """A table at ``path`` with ``keys``, in ``buckets`` buckets; the number is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.log = CommitLog(spark, f"{self.path}/log")

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``__bucket``, by their key as text; null where a key is."""
        whole = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in self.keys])
        return rows.withColumn("__bucket", F.when(whole, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")))

    def read(self, at: Snapshot | None = None, buckets: Sequence[int] | None = None, loose: bool = True) -> DataFrame | None:
        """The rows of a version, of some buckets or of all; ``loose`` adds those of null keys."""
        parts = {p: f for p, f in (at or self.log.snapshot()).parts.items() if isinstance(f, str) and "/" in f}
        folders = [f"{self.path}/{f}" for p, f in sorted(parts.items()) if (p < 0 and loose) or (p >= 0 and (buckets is None or p in {*buckets}))]
        return self.spark.read.parquet(*folders) if folders else None

    def lookup(self, wanted: DataFrame, at: Snapshot | None = None) -> DataFrame | None:
        """The rows of the keys of ``wanted``; other buckets are not opened."""
        rows = self.read(at, self.touched(wanted), loose=False)
        return None if rows is None else rows.join(wanted.select(*self.keys).distinct(), self.keys, "left_semi").select(*rows.columns)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``, as many as the table has at most."""
        return sorted(r[0] for r in self.placed(rows.select(*self.keys)).select("__bucket").where("__bucket is not null").distinct().collect())

    def _load(self, source: DataFrame, change: Callable[[DataFrame | None, DataFrame], DataFrame], more: dict | None = None, base: Snapshot | None = None) -> Snapshot:
        """Writes ``change(old rows, source)`` of the touched buckets, and the source's rows of null keys."""
        base = base or self.log.snapshot()
        source = staged(source, "bucket-source")
        whole, loose = merge.keyed(source, self.keys)
        touched, folder = self.touched(whole), f"data/{uuid.uuid4().hex}"
        parts: dict = dict(more or {})
        if touched:
            new = self.placed(change(self.read(base, touched, loose=False), whole))
            # a bucket is one task's file, sorted by key
            out = new.repartition(min(len(touched), 1000), "__bucket").sortWithinPartitions("__bucket", *self.keys).write.partitionBy("__bucket").option("compression", "zstd")
            for k in self.keys:
                out = out.option(f"parquet.bloom.filter.enabled#{k}", "true")
            out.parquet(f"{self.path}/{folder}")
            filled = {r[0] for r in self.spark.read.parquet(f"{self.path}/{folder}").select("__bucket").distinct().collect()} if new.columns else set()
            parts |= {b: f"{folder}/__bucket={b}" if b in filled else "" for b in touched}
        if not loose.isEmpty():
            loose.write.option("compression", "zstd").parquet(f"{self.path}/{folder}-loose")
            parts[-1 - int(uuid.uuid4().int % 2**62)] = f"{folder}-loose"
        return self.log.commit(base, parts) if parts else base

    def _target(self, old: DataFrame | None, source: DataFrame) -> DataFrame:
        return source.limit(0) if old is None else old

    def upsert(self, source: DataFrame, order: Sequence[str] | None = None, guard: bool = False) -> Snapshot:
        """``merge.upsert`` into the touched buckets [SNK-02, SNK-03, SNK-13]; the first load sets the columns."""
        return self._load(source, lambda old, new: merge.upsert(self._target(old, new.drop(*[c for c in order or () if old is not None and c not in old.columns])), new, self.keys, order, guard))

    def insert_missing(self, source: DataFrame, order: Sequence[str] | None = None) -> Snapshot:
        """``merge.insert_missing`` into the touched buckets [SNK-09]."""
        return self._load(source, lambda old, new: merge.insert_missing(self._target(old, new), new, self.keys, order))

    def delete_insert(self, source: DataFrame) -> Snapshot:
        """``merge.delete_insert`` in the touched buckets [SNK-05]."""
        return self._load(source, lambda old, new: merge.delete_insert(self._target(old, new), new, self.keys))


#: Where the log holds the next free id; it is no bucket and no part.
NEXT = -(2**63)


class Registry(BucketTable):
    """Keys and their ids [KEY-01, KEY-02]: issuing reads the buckets of the wanted keys alone.

    The next free id stands in the log, and a commit that issues ids claims it, so of two issuers at one
    time one starts again and no id is given twice.  An id once given never changes.
    """

    def issue(self, wanted: DataFrame, id_col: str = "id", base: Snapshot | None = None) -> Snapshot:
        """New keys of ``wanted`` get the ids that follow the last, in key order; null keys get none."""
        base = base or self.log.snapshot()
        wanted = staged(wanted.select(*self.keys).dropna().distinct(), "wanted")
        known = self.read(base, self.touched(wanted), loose=False)
        fresh = wanted if known is None else wanted.join(known, self.keys, "left_anti")
        top = int(base.parts.get(NEXT, "0"))
        new = staged(ids.numbered(fresh, self.keys, id_col).withColumn(id_col, F.col(id_col) + top), "issued")
        n = new.count()
        return self._load(new, lambda old, rows: rows if old is None else old.unionByName(rows), {NEXT: str(top + n)}, base) if n else base
