"""The stream of change signals: several tables, restarts, late signals, the skew, and files that are not opened."""

import datetime
import json
import time

import pytest

from tallyloom.sources.signal_stream import START, SignalReader, SignalSource

T0 = datetime.datetime(2024, 1, 1)


def at(minutes):
    return T0 + datetime.timedelta(minutes=minutes)


def put(spark, path, *rows):
    spark.createDataFrame([(k, t, "a") for k, t in rows], "k string, t timestamp, kind string").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def tables(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "abc"]
    put(spark, paths[0], ("A", at(1)), ("b", at(2)), (None, at(3)))
    put(spark, paths[1], ("A", at(5)))
    put(spark, paths[2], ("c", at(1)))
    return paths


def options(paths, **more):
    return {"tables": json.dumps([{"path": p, "key": "k", "at": "t", "name": p[-1]} for p in paths])} | {k: str(v) for k, v in more.items()}


def take(spark, home, paths, **more):
    spark.dataSource.register(SignalSource)
    signals = spark.readStream.format("change_signals").options(**options(paths, **more)).load()
    query = signals.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
    assert query.awaitTermination(90)
    rows = spark.read.schema("uid string, updated_at timestamp, source string").parquet(f"{home}/out").collect()
    return sorted((r.uid, int((r.updated_at - T0).total_seconds() // 60), r.source) for r in rows)


def test_restart_without_loss_or_repeat(spark, tmp_path, tables):
    first = [("a", 1, "a"), ("a", 5, "b"), ("b", 2, "a"), ("c", 1, "c")]
    assert take(spark, tmp_path, tables, overlap_s=0) == first
    put(spark, tables[0], ("d", at(7)))
    put(spark, tables[1], ("A", at(6)))
    assert take(spark, tmp_path, tables, overlap_s=0) == sorted([*first, ("d", 7, "a"), ("a", 6, "b")])
    assert take(spark, tmp_path, tables, overlap_s=0) == sorted([*first, ("d", 7, "a"), ("a", 6, "b")])


def test_late_signals_within_the_overlap(spark, tmp_path, tables):
    take(spark, tmp_path, tables)
    put(spark, tables[1], ("late", at(3)), ("new", at(9)))
    got = take(spark, tmp_path, tables)
    assert {("late", 3, "b"), ("new", 9, "b")} <= set(got)
    assert ("c", 1, "c") in got and got.count(("c", 1, "c")) == 1  # a table without news gives nothing again


def test_windows_and_files(spark, tables):
    reader = SignalReader(options(tables))
    end = reader.latestOffset()
    assert len(reader.partitions(reader.initialOffset(), end)) == 3 and reader.partitions(end, end) == []
    put(spark, tables[0], ("z", at(100)))
    later = reader.latestOffset()
    assert later["0"] - end["0"] == 98 * 60 * 10**6 or later["0"] > end["0"]
    assert len(reader.partitions(end, later)) == 2  # the new file, and the old one within the overlap
    assert len(SignalReader(options(tables, overlap_s=0)).partitions(end, later)) == 1
    now = datetime.datetime.now()
    put(spark, tables[2], ("ahead", now + datetime.timedelta(days=2)))
    assert reader.latestOffset()["2"] <= int(time.time() * 1e6) - reader.skew  # not beyond now less the skew
    assert SignalReader(options([])).latestOffset() == {} and START < 0
