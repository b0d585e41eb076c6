"""Roots of parts of any size, parts that follow the documents, and ids that need a wide store."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import token_store
from tallyloom.llm.queries import tokenizer
from tallyloom.llm.shared import shared_dir


def test_tree_is_merkle():
    for n in range(70):
        leaves, tree = [str(k).encode() for k in range(n)], token_store.Tree()
        for x in leaves:
            tree.add(x)
        blocks = [token_store.merkle(leaves[k : k + 8]) for k in range(0, n, 8)]
        assert tree.root() == token_store.merkle(leaves) == token_store.merkle_up(blocks)


def test_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_store, "PART", 40)
    monkeypatch.setattr(token_store, "LEAVES", 8)
    docs = spark.range(150).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"), F.lit("clash").alias("root"))
    path, vocabulary = shared_dir(spark, "test-store"), tokenizer("byte_bpe_50k.json")
    token_store.write_store(docs, path, vocabulary)
    token_store.verify(spark, path)
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()
    assert len(manifest) > 1 and sum(r.n_docs for r in manifest) == 150
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    want = Counter()
    for r in docs.collect():
        ids = np.array(t.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        want[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    rows = sorted(token_store.read_store(spark, path).collect(), key=lambda r: r.start)
    assert Counter((r.doc, r.n_ids, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_ids for r in rows])[:-1].tolist()
    order = [(r.doc is not None, r.doc) for r in rows]
    assert order == sorted(order)
    other = shared_dir(spark, "test-store")
    for name in ("chunks", "manifest"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{other}/{name}")
    recipes = spark.read.parquet(f"{path}/recipes")
    recipes.withColumn("root", F.when((F.col("kind") == "document") & (F.col("place") == 3), F.unhex(F.lit("00"))).otherwise(F.col("root"))).write.parquet(f"{other}/recipes")
    with pytest.raises(ValueError, match="manifest"):
        token_store.verify(spark, other)


def test_narrow_store_refuses_large_ids(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="wide store"):
        token_store.write_store(docs, shared_dir(spark, "test-store"), tokenizer("byte_bpe_50k.json"), end_id=70_000)
    path = shared_dir(spark, "test-store")
    token_store.write_store(docs, path, tokenizer("byte_bpe_50k.json"), end_id=70_000, wide=True)
    token_store.verify(spark, path)
    from tokenizers import Tokenizer

    ids = np.array(Tokenizer.from_file(tokenizer("byte_bpe_50k.json")).encode("some text", add_special_tokens=False).ids + [70_000], "<u4")
    assert [tuple(r) for r in token_store.read_store(spark, path).collect()] == [(1, 0, len(ids), zlib.crc32(ids.tobytes()))]
