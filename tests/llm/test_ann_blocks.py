"""Search over several cells and blocks, scaled components, recall and how much is verified."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import ann


def exact_best(rows, k, every=50):
    """The k best of each query by cosines in decimals of 60 digits, ties to the smaller id."""
    from decimal import Decimal, localcontext

    with localcontext(prec=60):
        norm = lambda a, b: sum(Decimal(x) * Decimal(y) for x, y in zip(a, b))
        sizes, out = {i: norm(v, v).sqrt() for i, v in rows.items()}, {}
        for q in rows:
            if q % every == 0:
                scored = sorted((-round(norm(rows[q], v) / sizes[q] / sizes[i], 40), i) for i, v in rows.items() if i != q)
                out[q] = [i for _, i in scored[:k]]
    return out


def brute(ids, vectors, k, every=50):
    v = vectors / np.abs(vectors).max(axis=1)[:, None]
    v /= np.linalg.norm(v, axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = v @ v[i]
        s[ids == ids[i]] = -9
        out[int(ids[i])] = {int(ids[j]): float(s[j]) for j in np.lexsort((ids, -s))[:k]}
    return out


def recall(found, want):
    have = defaultdict(dict)
    for r in found.collect():
        have[r.query_id][r.id] = r.score
        assert r.score == pytest.approx(want[r.query_id].get(r.id, r.score), abs=1e-12)
    return np.mean([len(have[q].keys() & want[q].keys()) / len(want[q]) for q in want])


def test_recall_and_verification(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    want = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float), 5)
    best, found = ann.search_all(df, None, "vec_id", "embedding", 5, 50)
    assert recall(best, want) >= 0.95
    assert found.agg(F.sum("verified")).first()[0] <= 0.15 * len(rows) * len(want)


def test_cells_blocks_and_chunks(spark, monkeypatch):
    """Clusters in cells of several blocks, more queries than go to a block at a time, and a hot vector."""
    monkeypatch.setattr(ann, "BLOCK", 400)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 24)) * 3
    v = np.concatenate([centres[rng.integers(0, 6, 2000)] + 0.4 * rng.standard_normal((2000, 24)), np.tile(centres[0], (1000, 1))])
    ids = rng.permutation(len(v))
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v)], "vec_id bigint, embedding array<double>").repartition(5)
    want = brute(ids, v, 5)
    best, found = ann.search_all(df, None, "vec_id", "embedding", 5, 50)
    cells = found.where("query is null").select("cell").distinct().count()
    assert cells > 3
    # equal vectors tie, so compare the scores that were found, not the ids
    have = defaultdict(list)
    for r in best.collect():
        have[r.query_id].append(r.score)
    assert np.mean([np.allclose(sorted(have[q]), sorted(want[q].values()), atol=1e-9) for q in want]) >= 0.95
    pairs = found.where("verified is not null").agg(F.sum("verified")).first()[0]
    assert pairs < 0.5 * len(v) * len(want)


def test_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1.0, 1.0]), (2, [1e-200, 1e-200]), (3, [0.0, 1e308]), (4, [-1e-310, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.id, round(r.score, 9)) for r in ann.nearest(df).orderBy("rank").collect()]
    assert got == [(1, 0.707106781), (2, 0.707106781), (3, 0.0), (4, -1.0)]


def test_own_queries(spark):
    df = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(1, 9)], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(100, [2.0, 1.0]), (3, [3.0, 1.0])], df.schema)
    got = {(r.query_id, r["rank"]): r.id for r in ann.nearest(df, queries=asked, k=2).collect()}
    assert got == {(100, 1): 2, (100, 2): 3, (3, 1): 4, (3, 2): 5}


def test_equal_and_parallel_vectors_by_id(spark, monkeypatch):
    """Ties are decided by id, over many blocks and whatever the vectors' lengths."""
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "QUERIES", 7)
    rng = np.random.default_rng(8)
    distinct = [[float(np.float32(x)) for x in v] for v in rng.standard_normal((60, 12))]
    distinct += [[float(x) for x in rng.permutation([1, 2, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])] for _ in range(30)]  # equal cosines that are no copies
    rows = {i: [x * (1, 3, 7, 0.1)[i % 3] for x in distinct[rng.integers(0, len(distinct))]] for i in rng.permutation(600).tolist()}
    df = spark.createDataFrame([(i, v) for i, v in rows.items()], "vec_id bigint, embedding array<double>").repartition(5)
    want = exact_best(rows, 5, every=20)
    have = defaultdict(list)
    for r in ann.nearest(df, every=20).orderBy("query_id", "rank").collect():
        have[r.query_id].append(r.id)
    assert have.keys() == want.keys()
    assert {q: have[q] for q in want if have[q] != want[q]} == {}


def test_cosines_are_nearest_doubles():
    from fractions import Fraction
    from math import isqrt

    rng = np.random.default_rng(2)
    a, b = rng.standard_normal((2, 300, 17))
    for x, y, got in zip(a, b, ann.cosines(a, b)):
        dot, xx, yy = (sum(Fraction(p) * Fraction(q) for p, q in zip(u, v)) for u, v in ((x, y), (x, x), (y, y)))
        root = Fraction(isqrt(int(xx * yy * 4**200)), 2**200)
        assert got == float(dot / root)


def test_a_repeated_direction_of_a_third(spark):
    rows = [(i, [1.0, 2.0 + i % 3]) for i in range(300)] + [(1000 + i, [0.5, 1.0]) for i in range(150)] + [(50, [9.0, 1.0]), (50, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    have = defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        have[r.query_id].append((r.id, r.score))
    for q in (0, 150, 1050, 1100):
        want = [i for i in (0, 3, 6, 9, 12, 15) if i != q][:5]
        assert [i for i, _ in have[q]] == want and {s for _, s in have[q]} == {1.0}
    assert [i for i, _ in have[50]] == [0, 2, 3, 5, 6]  # found with both of its vectors
