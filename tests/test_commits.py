"""The commit log, concurrent publishers, the tree of fingerprints, and merges with null keys."""

import threading

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import merge
from tallyloom.plans import commits
from tallyloom.plans.commits import CommitLog, ConflictError, Snapshot
from tallyloom.plans.publish import Store
from tallyloom.specs import PublishSpec

SPEC = PublishSpec("part", ("doc", "line"), ("doc",), ("doc", "line", "item"), ("amount",), on_empty="clear")
FACTS = "part int, doc bigint, line int, item int, amount double"


def test_log(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE", 3)
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.snapshot() == Snapshot(0, {})
    start = log.snapshot()
    for k in range(1, 8):
        log.commit(log.snapshot(), {k: f"f{k}"})
    assert log.snapshot() == Snapshot(7, {k: f"f{k}" for k in range(1, 8)})
    assert log.snapshot(4).parts == {k: f"f{k}" for k in range(1, 5)} and "whole" in log.read(6)
    log.commit(log.snapshot(), {2: ""})
    assert 2 not in log.snapshot().parts and 2 in log.snapshot(7).parts
    assert not log.put(8, {"parts": {}})
    with pytest.raises(ConflictError):
        log.commit(start, {9: "x", 3: "y"})
    assert log.commit(start, {9: "x"}).parts[9] == "x"  # other parts go in after all that came
    with pytest.raises(ConflictError):
        log.commit(start, {10: "x"}, reads=[5])
    with pytest.raises(ValueError, match="no version"):
        log.snapshot(77)


def test_many_writers(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    base, errors = log.snapshot(), []

    def write(k):
        try:
            CommitLog(spark, str(tmp_path / "log")).commit(base, {k // 2: f"by {k}"})
        except ConflictError:
            errors.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    parts = log.snapshot().parts
    assert sorted(parts) == list(range(6)) and len(errors) == 6  # of two writers of a part one lands
    assert {int(x.split()[1]) for x in parts.values()} | set(errors) == set(range(12))


def test_publishers_at_one_time(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    rows = lambda *r: spark.createDataFrame(list(r), FACTS)
    store.publish(rows((1, 10, 1, 5, 1.0), (2, 20, 1, 5, 2.0), (3, 30, 1, 5, 3.0)), [1, 2, 3])
    done = {}

    def publish(name, part, amount):
        try:
            done[name] = Store(spark, store.path, SPEC).publish(rows((part, part * 10, 1, 5, amount)), [part], base=at)
        except ConflictError:
            done[name] = "conflict"

    at = store.snapshot()
    threads = [threading.Thread(target=publish, args=x) for x in (("a", 1, 7.0), ("b", 2, 8.0), ("c", 1, 9.0))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(str(done[n]) for n in "ac")[1] == "{1: 'published'}" or "conflict" in (done["a"], done["c"])
    assert [done["a"], done["c"]].count("conflict") == 1 and done["b"] == {2: "published"}
    now = {r.part: r.amount for r in store.current().collect()}
    assert now[2] == 8.0 and now[1] in (7.0, 9.0) and now[3] == 3.0
    assert {r.part: r.amount for r in store.current(at=at).collect()} == {1: 1.0, 2: 2.0, 3: 3.0}


def test_a_patch_meets_its_document_elsewhere(spark, tmp_path):
    """Between reading and committing, another publisher puts a changed document into a partition that the patch does not touch."""
    store = Store(spark, str(tmp_path / "t"), SPEC)
    store.publish(spark.createDataFrame([(1, 10, 1, 5, 1.0), (2, 20, 1, 5, 2.0)], FACTS), [1, 2])
    other = Store(spark, store.path, SPEC)
    publish = store.publish

    def late(*args):
        other.publish(spark.createDataFrame([(3, 10, 2, 5, 4.0)], FACTS), [3])
        return publish(*args)

    store.publish = late
    ten = spark.createDataFrame([(10,)], "doc bigint")
    with pytest.raises(ConflictError):
        store.apply(ten, spark.createDataFrame([(1, 10, 1, 5, 6.0)], FACTS))
    store.publish = publish
    store.apply(ten, spark.createDataFrame([(1, 10, 1, 5, 6.0)], FACTS))
    assert sorted((r.part, r.doc, r.amount) for r in store.current().collect()) == [(1, 10, 6.0), (2, 20, 2.0)]


def test_tree_is_kept_up_and_descended(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    base = spark.range(3000).select((F.col("id") % 5).cast("int").alias("part"), F.col("id").alias("doc"), F.explode(F.array(F.lit(1), F.lit(2))).alias("line"), F.lit(4).alias("item"), (F.col("id") / 8).alias("amount"))
    store.publish(base, [0, 1, 2, 3, 4])
    changed = base.where("doc % 100 = 7").select("doc").distinct()
    fresh = base.where("doc % 200 = 7").withColumn("part", ((F.col("part") + 1) % 5).cast("int")).withColumn("amount", F.lit(2.5))
    store.apply(changed, fresh)
    want = base.where("doc % 100 <> 7").unionByName(fresh)
    assert store.sweep(want).isEmpty() and store.differing_documents(want).isEmpty()
    plain = lambda df: sorted(map(tuple, df.select("part", "doc", "n", "checksum", "sum_amount").collect()))
    from tallyloom.operators.fingerprint import fingerprint

    assert plain(store.documents()) == plain(fingerprint(want, SPEC.checksum, SPEC.measures, ["part", "doc"]))
    source = want.where("doc <> 11").withColumn("amount", F.when(F.col("doc") == 12, 0.0).otherwise(F.col("amount"))).unionByName(spark.createDataFrame([(3, 9999, 1, 1, 1.0)], FACTS))
    got = store.differing_documents(source)
    assert sorted(map(tuple, got.collect())) == [(1, 11, "deleted"), (2, 12, "changed"), (3, 9999, "new")]
    assert sorted(r.part for r in store.sweep(source).collect()) == [1, 2, 3]
    read = [f for f in got.inputFiles() if f"{tmp_path}/t/" in f]
    assert read and all("/docs/" in f for f in read) and len({f.rsplit("/", 1)[0] for f in read}) <= 3  # of the store's rows none, of its tree a bucket a document


def test_a_store_that_loses_all(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    rows = spark.createDataFrame([(1, 10, 1, 5, 1.0)], FACTS)
    assert store.publish(rows.limit(0), [1]) == {1: "cleared"} and store.current() is None
    store.publish(rows, [1])
    assert store.apply(rows.select("doc"), rows.limit(0)) == {1: "cleared"}
    assert store.current() is None and store.documents() is None and store.sums() is None
    assert [tuple(r) for r in store.differing_documents(rows).collect()] == [(1, 10, "new")]
    assert [r.part for r in store.sweep(rows).collect()] == [1] and store.sweep(rows.limit(0)).isEmpty()


def test_null_keys_stay(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "c"), (2, "d"), (None, "e"), (None, "e"), (None, "f")], "k int, v string")
    rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    loose = ["(None, 'b')", "(None, 'b')", "(None, 'e')", "(None, 'e')", "(None, 'f')"]
    for order in (None, ["v"]):
        assert rows(merge.upsert(target, source, ["k"], order)) == sorted(["(1, 'c')", "(2, 'd')", *loose])
        assert rows(merge.insert_missing(target, source, ["k"], order)) == sorted(["(1, 'a')", "(2, 'd')", *loose])
    pair = spark.createDataFrame([(1, None, "x"), (1, None, "x")], "a int, b int, v string")
    assert merge.upsert(pair, pair, ["a", "b"]).count() == 4
