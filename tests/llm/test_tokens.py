"""The encoder gives the library's ids on any text."""

import random

import numpy as np
import pytest

from tallyloom.llm import tokens
from tallyloom.llm.queries import tokenizer

PARTS = ["a", "B", "é", "́", "12", ".", ",", "!!", "'s", "ß", "İ", "Σ", "中", " ", " ", "  ", "\n", "\n\n", " \n", "\t", "\r", "\0", "\x1c", "\x85", "\xa0", " ", "<|endoftext|>", "<|", "word", "Word,"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(monkeypatch, name):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "TABLE", 300)  # so that the table starts anew again and again
    monkeypatch.setattr(tokens, "STEP", 60)
    plain, encoder, rng = Tokenizer.from_file(tokenizer(name)), tokens.Encoder(tokenizer(name)), random.Random(1)
    plain.encode_special_tokens = True
    for _ in range(300):
        texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(8)]
        have = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)]
        assert have == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_plain_characters(name):
    """Every character that goes past the library's own pattern, beside every class of neighbour, and lines of such words."""
    from tokenizers import Tokenizer

    plain, encoder, rng = Tokenizer.from_file(tokenizer(name)), tokens.Encoder(tokenizer(name), special=True), random.Random(2)
    letters = [chr(c) for c in range(33, 0x250)]
    texts = ["x " + " ".join(f"{c} a{c} {c}a 1{c} {c}1 ,{c} {c}, {c}{c}" for c in letters[k : k + 20]) for k in range(0, len(letters), 20)]
    texts += ["\n".join(" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(6)) for _ in range(5)) for _ in range(300)]
    have = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)]
    assert have == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    again = [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)]
    assert again == have


def test_distinct_pieces_are_looked_up_once():
    """A piece that a step holds often costs one look into the table; odd texts between others keep their places."""

    class Looks(tokens.Codes):
        def __getitem__(self, piece):
            looks.append(piece)
            return super().__getitem__(piece)

    from tokenizers import Tokenizer

    looks, plain, encoder = [], Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), tokens.Encoder(tokenizer("byte_bpe_50k.json"))
    encoder.code = Looks()
    texts = ["one two\none two", "  odd  text\n", "", "two one, two", "\0", "one two\ttwo one"] * 50
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(looks) == len(set(looks))
