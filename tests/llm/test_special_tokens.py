"""Texts that hold the strings of special tokens get the ids of an unaltered library."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import packing, token_store, tokens
from tallyloom.llm.queries import tokenizer
from tallyloom.llm.shared import shared_dir

PARTS = ["a", "B", "é", "12", ".", "'s", "中", " ", " ", "  ", "\n", "\n\n", "\t", "\0", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "word", "Word,"]
TEXTS = ["one <|endoftext|> two", "<|startoftext|>\nthree", "plain words", "<|endoftext|><|endoftext|>", "", None]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(monkeypatch, name):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "TABLE", 300)
    monkeypatch.setattr(tokens, "STEP", 60)
    plain, encoder, rng = Tokenizer.from_file(tokenizer(name)), tokens.encoder(tokenizer(name)), random.Random(1)
    for _ in range(300):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(8)]
        have = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)]
        assert have == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_operators(spark):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")

    def want(path, end):
        t = Tokenizer.from_file(path)
        ids = [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in TEXTS]
        return Counter((k, len(x), zlib.crc32(x.tobytes())) for k, x in enumerate(ids))

    path = tokenizer("word_bpe_49k.json")
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in packing.pack(docs, path).collect()) == want(path, 1)
    path, store = tokenizer("byte_bpe_50k.json"), shared_dir(spark, "test-store")
    token_store.write_store(docs, store, path)
    assert Counter((r.doc, r.n_ids, r.ids_crc32) for r in token_store.read_store(spark, store).collect()) == want(path, 2)
