"""Buckets beyond one block of members, and texts that share a short key."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import near_dedup
from tests.llm.test_operators import brute_classes, pairs


def mixed_rows(seed, boilerplate, groups=10, copies=9):
    """Groups of near copies around a shared passage, so that many texts of different groups meet in a bucket."""
    rng, rows = random.Random(seed), []
    words = [f"w{k}" for k in range(400)]
    shared = [rng.choice(words) for _ in range(boilerplate)]
    for g in range(groups):
        base = shared + [rng.choice(words) for _ in range(60)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("boilerplate", [60, 240])
@pytest.mark.parametrize("agreement", [near_dedup.LEAST_AGREEMENT, 0.0])
def test_many_blocks(spark, monkeypatch, boilerplate, agreement):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = mixed_rows(11, boilerplate)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(pairs(near_dedup.near_classes(df, agreement=agreement), "id", "class_id")) == brute_classes(rows, "count")


def test_shared_short_keys(spark, monkeypatch):
    """Texts whose short keys are equal are told apart by the rest of the key."""
    monkeypatch.setattr(near_dedup, "short_key", lambda key: F.conv(F.substring(F.hex(key), 1, 1), 16, 10).cast("long").alias("t"))
    rows = mixed_rows(12, 20)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(pairs(near_dedup.near_classes(df), "id", "class_id")) == brute_classes(rows, "count")


def test_counts_weigh(spark):
    """A passage repeated ten times and the passage alone share all shingles but not their weights."""
    passage = " ".join(f"x{k}" for k in range(30))
    rows = [(1, " ".join([passage] * 10)), (2, passage), (3, " ".join([passage] * 9))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(pairs(near_dedup.near_classes(df), "id", "class_id")) == brute_classes(rows, "count") == [(1, 1), (2, 2), (3, 1)]
    assert sorted(pairs(near_dedup.near_classes(df, weighting="distinct"), "id", "class_id")) == brute_classes(rows) == [(1, 1), (2, 1), (3, 1)]
