"""The program itself places the pieces, and needs no more sequences than best fit alone."""

from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import packing
from tallyloom.llm.queries import tokenizer


def alone(histogram):
    need = np.zeros(packing.CAPACITY + 1, int)
    for length, n in histogram.items():
        need[length] = n
    return sum(n for n, _ in packing.best_fit(need, [], packing.CAPACITY))


@pytest.mark.parametrize(("sf", "share"), [("sf0.01", 0.8), ("sf0.1", 0.9)])
def test_program_places_documents(spark, sf, share):
    cut = packing.pieces(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"), tokenizer("word_bpe_49k.json"))
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}
    left, groups = packing.program(histogram)
    total, tokens = sum(histogram.values()), sum(length * n for length, n in histogram.items())
    assert sum(n * sum(config.values()) for n, config in groups) == total - left.sum() >= share * total
    sequences = sum(n for n, _ in packing.plan_sequences(histogram))
    assert -(-tokens // packing.CAPACITY) <= sequences <= alone(histogram)


def test_configuration_is_best():
    """The dynamic program against all multisets."""
    rng = np.random.default_rng(8)
    for _ in range(60):
        lengths = np.concatenate([[0], np.sort(rng.choice(np.arange(1, 12), 4, replace=False))])
        worth, most, capacity = np.concatenate([[0], rng.random(4)]), np.concatenate([[0], rng.integers(0, 4, 4)]), int(rng.integers(12, 20))
        config = packing.best_configuration(lengths, worth, most, capacity)
        assert sum(lengths[s] * n for s, n in config.items()) <= capacity and all(n <= most[s] for s, n in config.items())
        best = max(sum(w * n for w, n in zip(worth[1:], x)) for x in np.ndindex(*(most[1:] + 1)) if sum(a * n for a, n in zip(lengths[1:], x)) <= capacity)
        assert sum(worth[s] * n for s, n in config.items()) == pytest.approx(best)


def test_large_counts_cost_no_more():
    """Work follows the lengths, not the pieces: a billion pieces are planned like some thousands."""
    rng = np.random.default_rng(9)
    few = Counter(rng.integers(1, 400, 3000).tolist()) | Counter(rng.integers(400, 4097, 900).tolist())
    many = {length: n * 300_000 + length for length, n in few.items()}
    plan, held = packing.plan_sequences(many), Counter()
    for n, config in plan:
        assert sum(length * k for length, k in config.items()) <= packing.CAPACITY
        for length, k in config.items():
            held[length] += n * k
    assert held == many and len(plan) < 20_000
    assert sum(n for n, _ in plan) <= 1.001 * alone(many)
