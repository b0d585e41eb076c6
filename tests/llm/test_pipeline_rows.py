"""Every stage of the pipeline against a brute-force version, on odd rows, on an empty table, and all of them in a row."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors

import corpus_pipeline
from tallyloom.llm import source_mix, toxicity
from tallyloom.llm.queries import tokenizer, toxicity_model
from tallyloom.llm.shared import settled, table
from tests.llm.test_features import plain_features
from tests.llm.test_operators import brute_classes

SF = "/root/testdata/sf0.01"
STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def plain_scores(texts, model):
    """Each text's score: the plain features through every tree, summed, and on the calibration's line."""
    if model.trees is None:
        return dict.fromkeys({t or "" for t in texts}, model.constant)
    knots, values = model.calibration.boundaries.toArray(), model.calibration.predictions.toArray()
    trees, out = list(zip(model.trees.treeWeights, model.trees.trees)), {}
    for text in {t or "" for t in texts}:
        x = Vectors.dense(plain_features(text, model.lexicon))
        raw = 1 / (1 + np.exp(-2 * sum(w * t.predict(x) for w, t in trees)))
        out[text] = (1 - toxicity.RAW) * float(np.interp(raw, knots, values)) + toxicity.RAW * raw
    return out


def plain_line_dedup(rows):
    """Texts after later occurrences of windows went: three lines, one or two lines of over 50 words, all of a text of one or two lines."""
    seen, gone = set(), defaultdict(set)
    for d, t in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0], r[1])):
        lines = t.split("\n")
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
        windows = [(k, 3) for k in range(len(lines) - 2)] + [(k, n) for n in (1, 2) for k in range(len(lines) - n + 1) if len(lines) == n or sum(words[k : k + n]) > 50]
        for k, n in sorted(windows):
            w = tuple(lines[k : k + n])
            if not any(x.strip(" ") for x in w):
                continue
            if w in seen:
                gone[(d, t)] |= set(range(k, k + n))
            seen.add(w)
    return Counter((r[0], None if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone[(r[0], r[1])]), *r[2:]) for r in rows)


def test_toxicity_stage(spark, docs):
    bad = spark.createDataFrame([(900 + k, r.text, "en", "s1", 1, "kept", 1) for k, r in enumerate(table(spark, SF, "documents").join(table(spark, SF, "labels").where("toxic = 1"), "doc_id").limit(20).collect())], docs.schema)
    rows = docs.union(bad)
    model = toxicity_model(spark, SF)
    kept = STAGE["toxicity"](spark, rows, SF)
    assert kept.columns == docs.columns
    have = rows.collect()
    score = plain_scores([r.text for r in have], model)
    want = Counter(tuple(r) for r in have if score[r.text or ""] < toxicity.THRESHOLD)
    assert rows_of(kept) == want and sum(want.values()) < rows.count()


def test_line_stage(spark, docs):
    passage = " ".join(f"word{k}" for k in range(60))
    more = [(200, f"a\n{passage}\nb", "en", "s0", 1, "kept", 1), (201, f"c\n{passage}", "en", "s0", 1, "kept", 1), (202, passage, None, None, None, None, None), (None, passage, "en", "s0", 1, "kept", 1)]
    rows = docs.union(spark.createDataFrame(more, docs.schema))
    out = STAGE["line_dedup"](spark, rows, SF)
    assert out.columns == docs.columns
    have = [tuple(r) for r in rows.collect()]
    assert rows_of(out) == plain_line_dedup(have)


def test_near_stage(spark, docs):
    near = " ".join(f"n{k}" for k in range(200))
    more = [(300 + k, near.replace(f"n{50 * k + 10}", "x"), "en", "s0", 1, "kept", 1) for k in range(3)]
    rows = docs.union(spark.createDataFrame(more, docs.schema))
    out = STAGE["near_dedup"](spark, rows, SF)
    assert out.columns == docs.columns
    have = [tuple(r) for r in rows.collect()]
    groups = defaultdict(set)
    for k, c in brute_classes([(k, r[1]) for k, r in enumerate(have)], "count"):
        groups[c].add(have[k][0])
    want = Counter(min((d for d in ids if d is not None), default=None) for ids in groups.values())
    kept = [tuple(r) for r in out.collect()]
    assert Counter(r[0] for r in kept) == want and all(r in have for r in kept)


def test_mix_stage(spark, docs):
    out = STAGE["mix_sources"](spark, docs, SF)
    assert out.columns == docs.columns
    con, taken = duckdb.connect(), Counter()
    con.register("documents", docs.toArrow())
    for doc, size, _, _, n in con.sql(source_mix.oracle()).fetchall():
        if n:
            taken[(doc, size)] += n // size
    size = lambda t: len(re.findall(source_mix.WORD, t or ""))
    assert Counter((r.doc_id, size(r.text)) for r in out.collect()) == taken
    assert all(tuple(r) in rows_of(docs) for r in out.collect())


def plain_pieces(rows):
    from tokenizers import Tokenizer

    t, want = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), Counter()
    for r in rows:
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(r.doc_id, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    return want


def packed(out, want):
    rows = out.collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_pack_stage(spark, docs):
    packed(STAGE["best_fit_packing"](spark, docs, SF), plain_pieces(docs.collect()))


def test_empty_table(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        out = settled(stage(spark, docs, SF), f"test-empty-{name}")
        assert out.count() == 0
        docs = out if name != "best_fit_packing" else docs


def test_run(spark):
    """``run`` over whole tables gives what the stages give one by one in plain Python."""
    small = "/root/testdata/sf0.001"
    model = toxicity_model(spark, small)
    rows = [tuple(r) for r in table(spark, small, "documents").collect()]
    columns = table(spark, small, "documents").columns
    d, text = columns.index("doc_id"), columns.index("text")
    assert (d, text) == (0, 1)
    score = plain_scores([r[1] for r in rows], model)
    rows = [r for r in rows if score[r[1] or ""] < toxicity.THRESHOLD]
    rows = list(plain_line_dedup(rows).elements())
    keep = {c for _, c in brute_classes([(r[0], r[1]) for r in rows], "count")}
    rows = [r for r in rows if r[0] in keep]
    con = duckdb.connect()
    con.register("documents", pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], names=columns))
    copies = {doc: n // size for doc, size, _, _, n in con.sql(source_mix.oracle()).fetchall() if n}
    by_id = {r[0]: r for r in rows}
    assert len(by_id) == len(rows)

    class Row:
        def __init__(self, doc_id, text):
            self.doc_id, self.text = doc_id, text

    mixed = [Row(k, by_id[k][1]) for k, n in copies.items() for _ in range(n)]
    packed(corpus_pipeline.run(spark, small), plain_pieces(mixed))
