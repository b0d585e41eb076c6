"""Each operator against a brute-force version, and on odd inputs."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import ann, language, line_dedup, media, near_dedup, packing, source_mix, token_store, toxicity, url_filter
from tallyloom.llm.queries import tokenizer
from tallyloom.llm.shared import shared_dir

SF = "/root/testdata/sf0.001"


def pairs(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


# ---- nearest neighbours


def brute_nearest(rows, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in (i for i in good if i % 50 == 0):
        s = sorted((-round(float(good[q] @ v / np.linalg.norm(good[q]) / np.linalg.norm(v)), 10), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        out[q] = [i for _, i in s[:k]]
    return out


def test_nearest_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    have = defaultdict(list)
    for q, i, rank in sorted(pairs(ann.nearest(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")), "query_id", "id", "rank"), key=lambda x: (x[0], x[2])):
        have[q].append(i)
    want = brute_nearest(rows, 5)
    assert set(have) == set(want)
    assert np.mean([len(set(have[q]) & set(want[q])) / 5 for q in want]) >= 0.9


def test_nearest_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (8, [1.0, None]), (None, [1.0, 2.0]), (50, [1.0, 0.0]), (100, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("clash"))
    found = pairs(ann.nearest(df).orderBy("query_id", "rank"), "query_id", "rank", "id")
    assert found == [(0, 1, 1), (0, 2, 50), (0, 3, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert ann.nearest(df.limit(0)).count() == 0


# ---- near-duplicates


def brute_classes(rows, weighting="distinct"):
    def bag(t):
        w = (t or "").lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    texts = list({t for _, t in rows if (t or "").split()})
    bags = [bag(t) if weighting == "count" else Counter(set(bag(t))) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both >= 0.8 * (sum((bags[i] | bags[j]).values())):
                root[top(i)] = top(j)
    group = lambda t: top(texts.index(t)) if (t or "").split() else None
    ids = defaultdict(list)
    for d, t in rows:
        ids[group(t)].append(d)
    return sorted((d, min(ids[group(t)])) for d, t in rows)


@pytest.mark.parametrize("weighting", ["distinct", "count"])
def test_near_classes(spark, weighting):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows, doc = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(120)] * rng.choice((1, 2))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(0, 7)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((doc, " ".join(copy)))
            doc += 1
    rows += [(doc, None), (doc + 1, ""), (doc + 2, ""), (doc + 3, "three words only"), (doc + 4, "Three  words only"), (doc + 5, rows[0][1]), (doc + 5, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row", F.lit("clash"))
    got = sorted(pairs(near_dedup.near_classes(df, weighting=weighting), "id", "class_id"))
    assert got == brute_classes(rows, weighting)
    kept = near_dedup.dedup_near(df, weighting=weighting)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute_classes(rows, weighting)})


def test_near_odd(docs, empty):
    assert near_dedup.near_classes(docs).count() == docs.count()
    assert near_dedup.dedup_near(empty).count() == 0
    assert near_dedup.dedup_near(docs).where("doc_id = 7").count() <= 3


def test_signature_similarity():
    rng = np.random.default_rng(1)
    a, b = np.arange(400, dtype=np.uint64), np.arange(100, 500, dtype=np.uint64)
    wa, wb = rng.uniform(0.1, 3, 500), rng.uniform(0.1, 3, 500)
    sig = near_dedup.signatures(np.concatenate([a, b]), np.concatenate([wa[:400], wb[100:]]), np.repeat([0, 1], 400), 2, 4096)
    low = np.minimum(wa[100:400], wb[100:400]).sum()
    high = np.maximum(wa[100:400], wb[100:400]).sum() + wa[:100].sum() + wb[400:].sum()
    assert abs((sig[0] == sig[1]).mean() - low / high) < 0.03


# ---- media


def test_media(docs, empty):
    out = media.wav_features(media.to_wav(docs)).select("text", "media", "media_features.*").collect()
    for r in out:
        raw = (r.text or "").encode()
        raw += bytes(-len(raw) % 64 or (0 if raw else 64))
        assert media.wav_payload(bytes(r.media)) == raw
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes) == (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), len(r.media))
        assert r.pairs == sorted(r.pairs)
    assert media.wav_features(media.to_wav(empty)).count() == 0


def test_fingerprint_finds_a_tone():
    tone = (128 + 100 * np.sin(2 * np.pi * 40 * np.arange(4096) / media.FRAME)).astype(np.uint8).tobytes()
    codes = media.fingerprint(tone)
    assert {c >> 14 & 0x3FF for c in codes if c >> 24 == 3} >= {40}
    assert media.fingerprint(bytes(640)) == []


# ---- URLs


def test_urls(spark):
    urls = ["http://A.Example.ORG/es/x", "http://a.example.org/en/12", "http://example.org/", "x://b.com/fr/casino?free", "x://com/de/", "x://notorg/", "http://porn.net/", "http://pornography.net/", "http://h.net/?hot&cheap", "http://h.net/hot/hot", "no scheme porn", "", None, "http://éporn.net", "a://b://c/d"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("url_terms", F.lit("clash"))
    got = [tuple(r) for r in url_filter.filter_urls(df).select("url_host", "url_path", "url_rule", "url_verdict").collect()]
    assert got == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("a.example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/", "org/", "allow"), ("b.com", "/fr/casino", "com/fr/", "allow"),
        ("com", "/de/", "com/de/", "block"), ("notorg", "/", None, "allow"), ("porn.net", "/", None, "block"), ("pornography.net", "/", None, "allow"), ("h.net", "/", None, "block"), ("h.net", "/hot/hot", None, "allow"),
        ("", "", None, "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("éporn.net", "", None, "block"), ("b:", "//c/d", None, "allow"),
    ]
    assert url_filter.filter_urls(df.limit(0)).count() == 0


# ---- packing


def test_plan_holds_histogram_and_is_tight():
    rng = np.random.default_rng(3)
    for lengths in (rng.integers(1, 4097, 3000), rng.integers(1366, 2049, 3000), np.full(500, 1365), np.array([4096] * 5), np.array([], int)):
        h = dict(Counter(lengths.tolist()))
        plan = packing.plan_sequences(h)
        held = Counter()
        for n, config in plan:
            assert sum(x * k for x, k in config.items()) <= 4096
            for x, k in config.items():
                held[x] += n * k
        assert +held == Counter(h)
        need = np.zeros(4097, int)
        for x, n in h.items():
            need[x] = n
        assert sum(n for n, _ in plan) <= sum(n for n, _ in packing.best_fit(need, [], 4096)) * 1.01 + 1


def test_pack(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = Counter()
    for r in docs.collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[(r.doc_id, k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes()))] += 1
    out = packing.pack(docs, path).collect()
    assert Counter(tuple(r)[:5] for r in out) == want
    held = defaultdict(list)
    for r in out:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(empty, path).count() == 0


# ---- lines


def brute_lines(rows):
    """Which lines of which (id, text) go."""
    seen, gone = set(), defaultdict(set)
    for d, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0])):
        lines = t.split("\n")
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if not any(x.strip(" ") for x in w):
                continue
            if w in seen:
                gone[(d, t)] |= {k, k + 1, k + 2}
            seen.add(w)
    return gone


def test_lines(spark):
    rng = random.Random(2)
    rows = [(d, "\n".join(rng.choice("abcde ") for _ in range(rng.randrange(0, 30)))) for d in range(60)] + [(60, None), (61, ""), (62, "a\na\na\na\na\na"), (5, None)]
    rows.append(rows[3])
    gone = brute_lines(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pos", F.lit("clash"))
    out = line_dedup.dedup_lines(df, removed="removed")
    want = sorted(((d, t if (d, t) not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[(d, t)]), sorted(gone.get((d, t), ()))) for d, t in rows), key=repr)
    assert sorted(pairs(out, "doc_id", "text", "removed"), key=repr) == want


def test_lines_odd(docs, empty):
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(docs).count() == docs.count()
    assert line_dedup.dedup_lines(empty).count() == 0


# ---- toxicity


def test_toxicity_learns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = toxicity.train(docs, labels.where(~held))
    out = toxicity.score(docs, model).join(labels.where(held), "doc_id").select("toxicity", "toxic").collect()
    assert all(0 <= r.toxicity <= 1 for r in out)
    bad, good = [r.toxicity for r in out if r.toxic], [r.toxicity for r in out if not r.toxic]
    assert np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.85
    assert np.mean([g < toxicity.THRESHOLD for g in good]) > 0.95


def test_toxicity_odd(docs, empty):
    nothing = docs.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    model = toxicity.train(docs, nothing)
    assert {r.toxicity for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.reject_toxic(docs, model).count() == docs.count()
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(docs, nothing.withColumn("toxic", F.lit(1))).constant == 1.0


# ---- token store


def test_store(spark, docs, empty):
    from tokenizers import Tokenizer

    path, vocabulary = shared_dir(spark, "test-store"), tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(vocabulary)
    t.encode_special_tokens = True
    token_store.write_store(docs, path, vocabulary)
    token_store.verify(spark, path)
    out = sorted(pairs(token_store.read_store(spark, path), "start", "doc", "n_ids", "ids_crc32"))
    want, at = Counter(), 0
    for r in docs.collect():
        ids = np.array(t.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        want[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter(x[1:] for x in out) == want
    for start, _, n, _ in out:
        assert start == at
        at += n
    order = [(x[1] is not None, x[1]) for x in out]
    assert order == sorted(order)
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.where("blob is not null").count() == chunks.select("name").distinct().count()
    again = shared_dir(spark, "test-store")
    token_store.write_store(empty, again, vocabulary)
    assert token_store.read_store(spark, again).count() == 0


def test_store_detects_damage(spark, docs):
    path = shared_dir(spark, "test-store")
    token_store.write_store(docs.where("doc_id < 5"), path, tokenizer("byte_bpe_50k.json"))
    other = shared_dir(spark, "test-store")
    spark.read.parquet(f"{path}/chunks").withColumn("blob", F.when(F.col("blob").isNotNull(), F.concat(F.unhex(F.lit("FFFF")), F.expr("substring(blob, 3)")))).write.parquet(f"{other}/chunks")
    spark.read.parquet(f"{path}/recipes").write.parquet(f"{other}/recipes")
    spark.read.parquet(f"{path}/manifest").withColumn("n_ids", F.col("n_ids") + 1).write.parquet(f"{other}/manifest")
    with pytest.raises(Exception, match="does not match"):
        token_store.read_store(spark, other).collect()
    with pytest.raises(ValueError, match="manifest"):
        token_store.verify(spark, other)


def test_crc_join_and_cuts():
    rng = np.random.default_rng(4)
    for n, m in ((0, 5), (7, 0), (1000, 4 * 4096), (3, 1)):
        a, b = rng.bytes(n), rng.bytes(m)
        assert token_store.crc32_join(np.array([zlib.crc32(a)]), np.array([zlib.crc32(b)]), np.array([m]))[0] == zlib.crc32(a + b)
    ids = rng.integers(0, 50_000, 30_000).astype("<u4")
    ends = token_store.cuts(ids)
    assert ends[-1] == len(ids) and all(b - a <= token_store.MAX_IDS for a, b in zip([0, *ends], ends))
    shifted = token_store.cuts(np.concatenate([ids[:777], ids]))
    assert len({e + 777 for e in ends} & set(shifted)) > len(ends) // 2


# ---- language


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    out = language.identify(docs.where(held), language.train(docs.where(~held)))
    assert out.where("lang_pred = lang").count() >= 0.97 * out.count()
    assert out.where("lang_score < 0 or lang_score > 1").count() == 0


def test_language_odd(spark, docs, empty):
    model = language.train(docs)
    found = {(r.text or "")[:5]: (r.lang_pred, r.lang_score) for r in language.identify(docs, model).collect()}
    assert found[""] == ("und", 0.0) and found[" \n "] == ("und", 0.0) and found["alone"][0] == "en"
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0
    assert language.identify(spark.createDataFrame([("12 34 !?",)], "text string"), model).first().lang_pred == "und"


# ---- mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, budget, target = set(names), share * sum(sizes.values()), {}
    while left:
        level = (budget - sum(target.values())) / sum(w[s] for s in left)
        over = {s for s in left if level * w[s] > cap * sizes[s]}
        for s in over or left:
            target[s] = cap * sizes[s] if over else level * w[s]
        left -= over or left
    return target


def test_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pairs(source_mix.mix_plan(docs).join(docs.select("doc_id", "source", "text"), "doc_id"), "source", "text", "size", "source_size", "target", "copies")
    import re

    sizes, taken, largest = Counter(), Counter(), Counter()
    for s, text, size, _, _, copies in rows:
        assert size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and 0 <= copies <= 2
        sizes[s] += size
        taken[s] += size * copies
        largest[s] = max(largest[s], size)
    want = brute_targets(sizes)
    for s, _, _, source_size, target, _ in rows:
        assert source_size == sizes[s] and target == pytest.approx(want[s])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in want)
    again = source_mix.mix_plan(docs.repartition(7, "text"))
    assert sorted(pairs(again, "doc_id", "copies")) == sorted(pairs(source_mix.mix_plan(docs), "doc_id", "copies"))


def test_mix_is_fair(spark):
    """Over many seeds a document is taken as often as its source's rate says."""
    docs = spark.createDataFrame([(k, "w " * (1 + k % 5), "a" if k % 2 else "b") for k in range(40)], "doc_id bigint, text string, source string")
    total = Counter()
    for seed in range(12):
        total.update(dict(pairs(source_mix.mix_plan(docs, seed=f"s{seed}"), "doc_id", "copies")))
    rates = {r.doc_id: r.target / r.source_size for r in source_mix.mix_plan(docs).collect()}
    for parity in (0, 1):
        ids = [k for k in range(40) if k % 2 == parity]
        assert np.mean([total[k] / 12 for k in ids]) == pytest.approx(np.mean([rates[k] for k in ids]), abs=0.08)


def test_mix_odd(docs, empty):
    plan = source_mix.mix_plan(docs)
    assert plan.count() == docs.count()
    assert plan.where("size = 0 and copies > 0").count() == 0
    mixed = source_mix.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert source_mix.mix(empty).count() == 0
