"""Exact top-k against brute force: ties, negative scores, several blocks, chunks and slices, and odd rows."""

import math

import numpy as np
import pytest

from tallyloom.llm import exact_topk


def brute(rows, k=5, every=50):
    fine = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in fine if i % every == 0}:
        best = {}
        for qi, qv in fine:
            for i, v in fine:
                if qi == q and i != q and len(v) == len(qv):
                    best[i] = max(best.get(i, -(2**70)), sum(a * b for a, b in zip(qv, v)))
        out |= {(q, r, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1)}
    return out


def found(df, **options):
    rows = exact_topk.top_k(df, **options).collect()
    assert len(rows) == len({(r.query_id, r["rank"]) for r in rows})
    return {(r.query_id, r["rank"], r.id, r.score) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score bigint, row string")


ODD = [(None, [1.0, 2.0]), (200, None), (201, [1.0, None]), (202, [float("nan"), 1.0]), (203, [float("inf"), 1.0]), (250, [0.0, 0.0]), (251, []), (300, []), (350, [1.0]), (351, [2.0]), (400, [-1.0, -2.0, 3.0])]


@pytest.mark.parametrize("slices", [1, 2, 3])
def test_odd_rows_ties_and_copies(spark, slices):
    rng = np.random.default_rng(slices)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 2) / 7]) for i in range(160)] + [(i, [0.5, 0.5]) for i in range(500, 560)]
    rows += ODD + [(7, [0.5, 0.5])] * 3 + [(100, [1.0, 1.0]), (100, [-1.0, 2.0])]  # repeated rows, and ids with several vectors
    assert found(frame(spark, rows), slices=slices) == brute(rows)


def test_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "BLOCK", 60)
    monkeypatch.setattr(exact_topk, "CHUNK", 4)
    monkeypatch.setattr(exact_topk, "PAIRS", 100)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.standard_normal(9)]) for i in rng.permutation(600)] + [(1000 + i, [0.1] * 9) for i in range(300)]  # a third of one vector
    for slices in (2, 4):
        assert found(frame(spark, rows), slices=slices, every=30) == brute(rows, every=30)


def test_a_cutoff_spares_most_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    best, collected, _ = exact_topk.search(df, None, "vec_id", "embedding", 5, 50, 256.0, 2)
    assert best.count() == 200
    assert collected.count() < 0.1 * 2 * df.count() * 40


def test_large_components(spark):
    rows = [(0, [2.0**22, 3.0]), (1, [2.0**20, 1.0]), (2, [-(2.0**20), 5.0]), (3, [1.0, 1.0])]
    assert found(frame(spark, rows)) == brute(rows)
    for v in (1e300, 2.0**40):
        with pytest.raises(Exception, match="bits"):
            found(frame(spark, [(0, [v, v]), (1, [v, 1.0])]))


def test_few_none_and_own_queries(spark):
    assert found(frame(spark, [(0, [1.0])])) == set()
    assert found(frame(spark, [])) == set()
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.0, 1.0])]
    assert found(frame(spark, rows)) == brute(rows)
    asked = frame(spark, [(9, [1.0, 0.0]), (1, [1.0, 0.0])])
    assert found(frame(spark, rows), queries=asked, k=2) == {(9, 1, 1, 512 * 256), (9, 2, 0, 256 * 256), (1, 1, 0, 256 * 256), (1, 2, 2, 0)}
