"""Keyed tables in buckets: what a load touches, equals of whole-table merges, versions, conflicts, and registries."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import merge
from tallyloom.plans.buckets import BucketTable, Registry
from tallyloom.plans.commits import ConflictError

rows = lambda df: sorted(map(str, map(tuple, df.collect())))


def test_an_upsert_rewrites_its_own_buckets(spark, tmp_path):
    table, n = BucketTable(spark, str(tmp_path / "t"), ["k"], 512), 300_000
    table.upsert(spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = table.log.snapshot()
    source = spark.range(100).select((F.col("id") * 2999).alias("k"), F.lit("new").alias("v"))
    after = table.upsert(source)
    moved = {p for p, f in after.parts.items() if before.parts.get(p) != f}
    assert moved == set(table.touched(source)) and len(moved) <= 100
    got = table.read()
    assert got.count() == n and got.where("v = 'new'").count() == 100
    assert table.read(before).where("v = 'new'").isEmpty()
    assert len(table.lookup(source.limit(1)).inputFiles()) == 1


def test_equal_to_whole_merges(spark, tmp_path):
    target = spark.createDataFrame([(k if k % 4 else None, str(k % 3), f"t{k}", 0) for k in range(60)], "a int, b string, v string, w int").dropDuplicates(["a", "b", "v"])
    source = spark.createDataFrame([(k if k % 5 else None, str(k % 3), f"s{k}", k) for k in range(40, 90)] + [(41, "2", "s-later", 99)], "a int, b string, v string, w int")
    for name, args in (("upsert", (["w"],)), ("insert_missing", (["w"],)), ("delete_insert", ())):
        table = BucketTable(spark, str(tmp_path / name), ["a", "b"], 16)
        table.upsert(target, ["w"])
        first = merge.upsert(target.limit(0), target, ["a", "b"], ["w"])
        getattr(table, name)(source, *args)
        assert rows(table.read().select("a", "b", "v", "w")) == rows(getattr(merge, name)(first, source, ["a", "b"], *args).select("a", "b", "v", "w")), name


def test_writers_of_other_buckets(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 64)
    one = lambda k, v: spark.createDataFrame([(k, v)], "k int, v string")
    table.upsert(one(1, "a"))
    at = table.log.snapshot()
    other = next(k for k in range(2, 50) if table.touched(one(k, "")) != table.touched(one(1, "")))
    table.upsert(one(other, "b"))
    change = lambda old, new: merge.upsert(new.limit(0) if old is None else old, new, ["k"])
    table._load(one(1, "c"), change, base=at)
    assert rows(table.read().select("k", "v")) == sorted(["(1, 'c')", f"({other}, 'b')"])
    with pytest.raises(ConflictError):
        table._load(one(other, "d"), change, base=at)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(st.sampled_from([*"abcdefgh", None]), max_size=6), min_size=1, max_size=3))
def test_ids_never_change(spark, tmp_path_factory, batches):
    registry, seen = Registry(spark, str(tmp_path_factory.mktemp("r") / "t"), ["guid"], 4), {}
    for batch in batches:
        registry.issue(spark.createDataFrame([(g,) for g in batch], "guid string"))
        got = registry.read()
        now = {} if got is None else {r.guid: r.id for r in got.collect()}
        assert all(now[g] == i for g, i in seen.items()) and sorted(now.values()) == list(range(1, len(now) + 1))
        seen = now
    assert set(seen) == {g for b in batches for g in b if g}


def test_issuers_at_one_time(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"), ["guid"], 64)
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "guid string")
    registry.issue(keys("a", "b"))
    at = registry.log.snapshot()
    registry.issue(keys("c"))
    with pytest.raises(ConflictError):
        registry.issue(keys("d"), base=at)
    registry.issue(keys("d", "a"))
    assert {r.guid: r.id for r in registry.read().collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    before = registry.log.snapshot()
    assert registry.issue(keys("a", "d", "b")) == before  # nothing is new, nothing is written
