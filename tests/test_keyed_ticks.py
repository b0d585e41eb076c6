"""Ticks with keyed state: keys wait, arrive, vanish and age out; a tick reads what it touches; a restart changes nothing."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.plans.publish import Store
from tallyloom.specs import PublishSpec
from tallyloom.streaming import ticks

SPEC = PublishSpec("part", ("doc", "line"), ("doc",), ("doc", "line", "item"), ("amount",), on_empty="clear")
FACTS = "part int, doc bigint, line int, item int, amount double"


class Source:
    """A source whose documents change between ticks."""

    def __init__(self, spark, rows=()):
        self.spark, self.rows, self.asked = spark, list(rows), []

    def table(self):
        return self.spark.createDataFrame(self.rows, FACTS)

    def fetch(self, ready):
        return self.table().join(ready, F.col("doc").cast("string") == ready.uid, "left_semi")

    def exists(self, asked):
        self.asked.append(sorted(r.uid for r in asked.collect()))
        return self.table().select(F.col("doc").cast("string").alias("uid")).distinct()


def signal(spark, path, *keys, at=None):
    at = at or datetime.datetime.now()
    spark.createDataFrame([(str(k), at) for k in keys], "uid string, updated_at timestamp").coalesce(1).write.mode("append").parquet(path)


def tick(spark, home, store, source, look_back="INTERVAL 15 DAYS"):
    signals = spark.readStream.schema("uid string, updated_at timestamp").parquet(f"{home}/signals")
    query = ticks.keyed(signals, store, "doc", source.fetch, source.exists, home, look_back)
    assert query.awaitTermination(90)


def docs(store):
    return sorted((r.doc, r.part, r.amount) for r in store.current().collect())


def test_wait_arrive_vanish(spark, tmp_path):
    home, store = str(tmp_path), Store(spark, str(tmp_path / "t"), SPEC)
    source = Source(spark, [(1, 10, 1, 5, 1.0), (2, 20, 1, 5, 2.0)])
    signal(spark, f"{home}/signals", 10, 20, 77)
    tick(spark, home, store, source)
    assert docs(store) == [(10, 1, 1.0), (20, 2, 2.0)]
    source.rows = [(1, 20, 1, 5, 3.0), (3, 77, 1, 5, 9.0)]  # 10 is gone, 20 moved, 77 has come
    signal(spark, f"{home}/signals", 10, 20)
    tick(spark, home, store, source)
    assert docs(store) == [(20, 1, 3.0), (77, 3, 9.0)]
    assert source.asked[-1] == ["10", "20", "77"]  # 77 was asked for again without a signal
    asked = len(source.asked)
    tick(spark, home, store, source)  # answers are read, and nothing is open any more
    assert all(a == [] for a in source.asked[asked:]) and docs(store) == [(20, 1, 3.0), (77, 3, 9.0)]


def test_ageing_by_timer(spark, tmp_path):
    home, store = str(tmp_path), Store(spark, str(tmp_path / "t"), SPEC)
    source = Source(spark, [(1, 10, 1, 5, 1.0)])
    signal(spark, f"{home}/signals", 10, 88)
    tick(spark, home, store, source, "INTERVAL 20 SECONDS")
    time.sleep(21)
    signal(spark, f"{home}/signals", 10)
    tick(spark, home, store, source, "INTERVAL 20 SECONDS")
    aged = spark.read.schema("uid string, since timestamp, state string").parquet(f"{home}/aged/*")
    assert [r.uid for r in aged.collect()] == ["88"]
    tick(spark, home, store, source, "INTERVAL 20 SECONDS")
    assert "88" not in source.asked[-1]


def records_read(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def test_a_tick_reads_what_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    n = 400_000
    rows = spark.range(n).select((F.col("id") % 40).cast("int").alias("part"), F.col("id").alias("doc"), F.lit(1).alias("line"), F.lit(1).alias("item"), F.lit(1.0).alias("amount"))
    store.publish(rows, list(range(40)))
    source = Source(spark, [(3, 43, 1, 5, 7.0)])
    before = records_read(spark)
    asked = spark.createDataFrame([("43", datetime.datetime(2024, 1, 1))], "uid string, since timestamp")
    states = ticks.answer(store, "doc", source.fetch, source.exists, asked, F.current_timestamp(), "INTERVAL 15 DAYS")
    assert [r.state for r in states.collect()] == ["ready"]
    # one partition of 40 is read to be patched and once more as written, and of the tree one bucket of 64 a partition
    assert records_read(spark) - before < n / 4
    assert store.current().where("doc = 43").first().amount == 7.0 and store.current().count() == n


def test_a_failed_batch_runs_again(spark, tmp_path, monkeypatch):
    home, store = str(tmp_path), Store(spark, str(tmp_path / "t"), SPEC)
    source = Source(spark, [(1, 10, 1, 5, 1.0), (2, 20, 1, 5, 2.0)])
    signal(spark, f"{home}/signals", 10, 20, 30)
    whole = ticks.answer

    def broken(*args):
        whole(*args)
        raise OSError("lost after the work was done")

    monkeypatch.setattr(ticks, "answer", broken)
    with pytest.raises(Exception, match="lost after"):
        tick(spark, home, store, source)
    monkeypatch.setattr(ticks, "answer", whole)
    tick(spark, home, store, source)
    assert docs(store) == [(10, 1, 1.0), (20, 2, 2.0)]
