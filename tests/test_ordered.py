"""Selection, gaps, streaks, profiles and deep trees against plain Python, at sizes that no one task should hold."""

import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import audit, hierarchy


def test_medians(spark, monkeypatch):
    monkeypatch.setattr(audit, "FEW", 50)
    rnd = random.Random(4)
    groups = {"many": [rnd.gauss(0, 1e6) for _ in range(20_001)], "even": [float(rnd.randrange(1000)) for _ in range(5000)], "ties": [7.0] * 4000 + [1.0] * 10, "two": [1.0, 4.0], "split": [1.0] * 500 + [9.0] * 500, "inf": [float("inf")] * 80 + [0.0] * 10 + [-1e308] * 9, None: [3.0] * 51}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("two", None)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r.middle for r in audit.medians(df, "v", ["g"]).collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}
    whole = audit.medians(df, "v").collect()
    assert [r.middle for r in whole] == [statistics.median([v for vs in groups.values() for v in vs])]
    assert audit.medians(df.limit(0), "v").collect() == [] == audit.medians(df.limit(0), "v", ["g"]).collect()


def test_median_of_ten_million(spark):
    n = 10_000_001
    df = spark.range(n).select(F.pmod(F.col("id") * 7_368_787, F.lit(n)).cast("double").alias("v"))  # each value once
    assert audit.medians(df, "v").first().middle == (n - 1) / 2


@pytest.fixture(scope="module")
def runs(spark):
    rnd = random.Random(6)
    rows = [(k, "hot" if k % 3 else f"dag{k % 7}", rnd.randrange(10_000), rnd.choice(["ok", "ok", "bad", None])) for k in range(3000)]
    rows += [(k, "same", k - 5000, "ok") for k in range(5000, 6000)]  # a streak across all parts of its key
    df = spark.createDataFrame(rows, "run_id bigint, dag string, s bigint, status string").withColumn("at", F.timestamp_seconds("s"))
    return df, rows


def test_gaps_and_streaks(spark, runs):
    df, rows = runs
    by = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    want_gaps, want_streaks = {}, {}
    for dag, rs in by.items():
        gaps = [float(b[2] - a[2]) for a, b in zip(rs, rs[1:])]
        want_gaps[dag] = (len(gaps), min(gaps), statistics.median(gaps), max(gaps), sum(g > 9 for g in gaps))
        n, last = 0, object()
        for r in rs:
            n = n + 1 if r[3] == last else 1
            last = r[3]
            want_streaks[dag, last] = max(n, want_streaks.get((dag, last), 0))
    got = {r.dag: (r.n_gaps, r.least, r.middle, r.largest, r.n_over) for r in audit.run_gaps(df, "at", ["dag"], 9).collect()}
    assert got == want_gaps
    assert {(r.dag, r.status): r.longest for r in audit.streaks(df, ["dag"], "at", "status").collect()} == want_streaks
    parts = audit.in_parts(df, ["dag"], "at").groupBy("__part").count().collect()
    assert len(parts) > 4 and max(r["count"] for r in parts) < len(rows) / 3  # a key with half of the rows is several parts


def test_profile_is_one_scan(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 100).alias("c"), F.when(F.col("id") % 2 == 0, "00000000-0000-0000-0000-000000000000").alias("r"))
    near = audit.column_profile(df, ["id", "c", "r"], exact=False)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Range (") == 1
    rows = {r.column_name: r for r in near.collect()}
    assert abs(rows["id"].n_distinct - 20_000) < 600 and rows["c"].n_distinct == 100
    assert rows["r"].n_empty_refs == 10_000 and rows["r"].null_pct == 50.0 and rows["id"].n_empty_refs == 0
    exact = audit.column_profile(df, ["id", "c", "r"])
    assert "Expand" not in exact._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: r.n_distinct for r in exact.collect()} == {"id": 20_000, "c": 100, "r": 1}


def test_a_chain_of_100_000(spark):
    n = 100_000
    nodes = spark.range(n).select(F.col("id").alias("guid"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_guid"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    began = time.time()
    flat = hierarchy.flatten(nodes, 4)
    one = flat.agg(F.count("*"), F.count_if(F.col("category") == "n0"), F.count_if(F.col("subcategory3") == "n3")).first()
    assert tuple(one) == (n, n - 1, n - 4)
    assert time.time() - began < 60


def test_flatten_odd_trees(spark):
    tree = [(1, None, "root"), (2, 1, "a"), (3, 2, "b"), (4, 3, "c"), (5, 4, "d"), (6, 99, "lost"), (7, 6, "below"), (None, 1, "no id"), (8, 8, "self"), (9, 8, "under")]
    ring = [(100 + k, 100 + (k + 1) % 3, f"r{k}") for k in range(3)] + [(200, 100, "in"), (201, 200, "in too")]
    flat = hierarchy.flatten(spark.createDataFrame(tree + ring, "guid bigint, parent_guid bigint, name string"), 2)
    got = {r.id: tuple(r)[1:] for r in flat.collect()}
    assert got == {1: (None, None), 2: ("root", None), 3: ("root", "a"), 4: ("root", "a"), 5: ("root", "a"), 6: (None, None), 7: ("lost", None), None: (None, None), 8: (None, None), 9: ("self", None), 100: ("r2", "r1"), 101: ("r0", "r2"), 102: ("r1", "r0"), 200: ("r2", "r1"), 201: ("r2", "r1")}
