"""Whole texts to token ids with the tokenizers library, each distinct word encoded once a worker.

A tokenizer that splits texts into words before it merges gives a word the same ids wherever it
stands, so a text's ids are its words' ids in a row.  ``Encoder`` cuts a text before single spaces
and line feeds that stand between two characters that are no white space, numbers the distinct pieces
of some millions of characters in Arrow, looks each of these up once in a bounded table, and passes
only unseen pieces to the library.  Both kinds of vocabulary in use here never form a token across such
a cut: the byte-level one starts a token at the space, and has a token for a single line feed; the
word-end one drops white space.

Unseen pieces of Latin letters, digits and ASCII punctuation (no apostrophe) are cut here where the
vocabularies' patterns cut them, at each change of class, and go to the library's merges in one call
behind a splitter of one character; all other pieces go through the library's own normaliser and
pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

#: White space other than the space and the line feed, as Python and Unicode know it.
ODD_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Characters on whose classes all versions of Unicode, and on whose lower case Python and the library, agree: Latin letters, digits, punctuation.
_LETTER, _DIGIT, _MARK = "A-Za-zÀ-ÖØ-öø-įı-ſ", "0-9", r"!-&(-/:-@\[-`{-~"
_PLAIN = rf"\A\n?[{_LETTER}{_DIGIT}{_MARK}]+\z"
#: Pieces in the table at most; beyond it the table starts anew.
TABLE = 900_000
#: Characters encoded at a time.
STEP = 4_000_000


class Encoder:
    """``ids(texts)`` yields each text's ids as little-endian unsigned 32-bit bytes, without special tokens.

    ``code`` numbers the pieces; the ids of piece c are ``pool[start[c] : start[c] + length[c]]``.
    The strings of special tokens in a text are ordinary text, or with ``special`` the one id that the
    library gives them by default; a text that holds one then goes to the library whole.
    """

    def __init__(self, path: str, special: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.whole = ["\0", *(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if special)]
        self.prepare(Tokenizer)
        self.clear()

    def prepare(self, kind) -> None:
        """The merges behind a splitter at NUL, the pattern that cuts plain pieces, and which ids begin (or, with word ends, end) a part."""
        import numpy as np
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        suffix = self.tokenizer.model.end_of_word_suffix
        self.word_ends = bool(suffix)
        self.merges = kind(self.tokenizer.model)
        self.merges.pre_tokenizer = CharDelimiterSplit("\0")
        space, digits = ("", _DIGIT.join("[]")) if suffix else (" ?", f" ?[{_DIGIT}]+")
        self.parts = re.compile(rf"{'' if suffix else '\n|'}{space}[{_LETTER}]+|{digits}|{space}[{_MARK}]+").findall
        shown = {chr(b): ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0] for b in range(1, 128)}
        # a byte from 128 on is seen in a two-byte character: its second byte, or its first
        pairs = [ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0] for c in range(128, 2048)]
        shown |= {chr(b): pairs[k][j] for k in range(len(pairs)) for j, b in enumerate(chr(128 + k).encode())}
        self.shown = np.array([ord(shown.get(chr(b), chr(b))) for b in range(256)], "<u4")
        first = (shown[" "], shown["\n"])
        marks = [w.endswith(suffix) if suffix else w.startswith(first) for w in map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))]
        self.marks = np.array(marks, bool)

    def clear(self) -> None:
        import numpy as np

        self.code = Codes()
        self.pool, self.start, self.length = (np.zeros(1 << 16, kind) for kind in ("<u4", np.int64, np.int64))
        self.filled = self.known = 0

    def odd_pieces(self, text: str) -> list[str] | None:
        """The pieces of a text whose white space is not all single spaces and line feeds inside it; None for other texts.  One that holds a NUL, or a special token's string, stays whole."""
        if any(w in text for w in self.whole):
            return ["\0" + text]
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[-1:] in ("\n", " ") or text[:1] in ("\n", " ") or any(c in text for c in ODD_SPACE):
            cut = _CUT.split(text)
            return ["\0" + cut[0], *[p[1:] if p[0] == " " else p for p in cut[1:]]]
        return None

    def pieces(self, texts: list[str]):
        """(pieces of all texts in a row as a dictionary, numbers of pieces, places of the texts in that row).

        A text's first piece stands behind a NUL, the others without the space before them; line feeds stay.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        odd = {k: found for k, t in enumerate(texts) if (found := self.odd_pieces(t)) is not None}
        even = [k for k in range(len(texts)) if k not in odd]
        split = pc.split_pattern(pa.array(["\0" + texts[k].replace("\n", " \n") for k in even], pa.large_string()), " ")
        flat = pa.concat_arrays([split.flatten(), pa.array(list(chain.from_iterable(odd.values())), pa.large_string())])
        place = np.argsort(np.array([*even, *odd], np.int64))
        return flat.dictionary_encode(), np.array([*split.value_lengths().to_pylist(), *map(len, odd.values())], np.int64), place

    def encode(self, keys: list[str]):
        """(ids of all keys in a row, numbers of ids)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        fits = pc.match_substring_regex(pa.array(keys, pa.large_string()), _PLAIN).to_numpy(zero_copy_only=False)
        plain, others = np.flatnonzero(fits), np.flatnonzero(~fits).tolist()
        ids, owner = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        if len(plain):
            found, place = self.encode_plain([keys[k] for k in plain.tolist()])
            ids.append(found)
            owner.append(plain[place])
        for k, e in zip(others, self.tokenizer.encode_batch_fast([keys[k][1:] if keys[k][0] == "\0" else keys[k] if keys[k][0] == "\n" else " " + keys[k] for k in others], add_special_tokens=False)):
            ids.append(np.array(e.ids, "<u4"))
            owner.append(np.full(len(e.ids), k))
        owner = np.concatenate(owner)
        return np.concatenate(ids)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(keys))

    def encode_plain(self, keys: list[str]):
        """(ids, place of the key of each) of keys that ``_PLAIN`` fits.

        With word ends, an id that ends a word tells the parts apart, else the id of a space or line
        feed tells the keys apart; parts before which neither stands belong to the key before.
        """
        import numpy as np

        written = "".join([k if k[0] == "\n" else " " + k for k in keys])
        if self.word_ends:
            cut = [self.parts(k.lower()) for k in keys]
            of_part = np.repeat(np.arange(len(keys)), [len(p) for p in cut])
            parts = list(chain.from_iterable(cut))
        else:
            parts = self.parts(written)
        text = self.shown[np.frombuffer("\0".join(parts).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        marks = self.marks[ids]
        if self.word_ends:
            return ids, of_part[np.cumsum(marks) - marks]
        return ids, np.cumsum(marks) - 1

    def learn(self) -> None:
        """Encodes the pieces numbered since the last call."""
        import numpy as np

        ids, counts = self.encode(self.code.new)
        n, more = len(counts), len(ids)
        while self.filled + more > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.known + n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.pool[self.filled : self.filled + more] = ids
        self.start[self.known : self.known + n] = self.filled + np.cumsum(counts) - counts
        self.length[self.known : self.known + n] = counts
        self.filled, self.known = self.filled + more, self.known + n
        self.code.new.clear()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        import numpy as np

        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= STEP):
                size += len(texts[upto])
                upto += 1
            if len(self.code) > TABLE:
                self.clear()
            pieces, sizes, place = self.pieces(texts[at:upto])
            distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
            codes = np.fromiter(map(self.code.__getitem__, distinct), np.int64, len(distinct))[pieces.indices.to_numpy()]
            self.learn()
            n = self.length[codes]
            ends = np.cumsum(n)
            raw = self.pool[np.repeat(self.start[codes] - ends + n, n) + np.arange(ends[-1])].tobytes()
            last = ends[np.cumsum(sizes) - 1]
            first = last - np.add.reduceat(n, np.cumsum(sizes) - sizes)
            for a, b in zip(first[place].tolist(), last[place].tolist()):
                yield raw[4 * a : 4 * b]
            at = upto


class Codes(dict):
    """piece -> its number; a new piece gets the next one and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for the vocabulary at ``path``; later tasks of a worker find its tables filled."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, special=True)
    return _ENCODERS[path]
