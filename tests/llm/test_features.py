"""Features, fingerprints, votes and URL terms against plain versions, and odd rows through trained models."""

import cmath
import random
import re
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language, media, toxicity, url_filter
from tallyloom.llm.queries import ORACLE_SQL, op4_url_filters

# ---- media


def plain_fingerprint(samples: bytes):
    n_frames = -(-len(samples) // media.HOP) + 1
    level = float(np.round(sum(samples) / len(samples)))
    window = [0.5 - 0.5 * np.cos(2 * np.pi * k / media.FRAME) for k in range(media.FRAME)]
    turn = [cmath.exp(-2j * cmath.pi * k / media.FRAME) for k in range(media.FRAME)]
    found = []
    for f in range(n_frames):
        at = (f - 1) * media.HOP
        frame = [float(samples[i]) if 0 <= i < len(samples) else level for i in range(at, at + media.FRAME)]
        middle = sum(frame) / len(frame)
        x = [(v - middle) * w for v, w in zip(frame, window)]
        size = [round(abs(sum(v * turn[k * i % media.FRAME] for i, v in enumerate(x))), 3) for k in range(media.FRAME // 2 + 1)]
        tops = sorted((-size[k], k) for k in range(1, media.FRAME // 2) if size[k] > size[k - 1] and size[k] >= size[k + 1])[: media.PEAKS]
        found += [(f, k) for k in sorted(k for _, k in tops)]
    return sorted(f << 24 | a << 14 | b << 4 | g - f for i, (f, a) in enumerate(found) for g, b in found[i + 1 :] if g - f <= media.AHEAD)


def test_fingerprint_is_plain():
    rng = random.Random(4)
    for n in (64, 256, 320, 1024, 1280):
        samples = bytes(rng.randrange(32, 123) for _ in range(n - 64)) + bytes(64)
        assert media.fingerprint(samples) == plain_fingerprint(samples)


def test_windows_cover_every_sample():
    window = np.hanning(media.FRAME + 1)[:-1]
    for n in (64, 255, 256, 257, 5000):
        weight = np.zeros(n)
        for f in range(media.frames_of(n)):
            for i, w in enumerate(window):
                if 0 <= (f - 1) * media.HOP + i < n:
                    weight[(f - 1) * media.HOP + i] += w
        assert np.allclose(weight, 1)


def test_shifted_passage_shares_codes():
    rng = random.Random(5)
    passage = bytes(rng.randrange(97, 123) for _ in range(9000))
    pairs = lambda samples: {c & 0xFFFFFF for c in media.fingerprint(samples)}
    base, other = pairs(passage), pairs(bytes(rng.randrange(97, 123) for _ in range(9000)))
    shifted = pairs(bytes(rng.randrange(97, 123) for _ in range(96)) + passage)
    assert len(base & shifted) > 10 * max(1, len(base & other))  # white noise, in which nothing but the passage itself is alike


def test_media_keeps_clashing_columns(spark):
    df = spark.createDataFrame([("a text", "x", "y", 1), ("a text", "x", "y", 1), (None, None, None, None)], "text string, feature string, pairs string, payload_bytes int")
    out = media.wav_features(media.to_wav(df)).collect()
    assert [(r.feature, r.pairs, r.payload_bytes) for r in out] == [("x", "y", 1), ("x", "y", 1), (None, None, None)]
    assert out[0].media_features == out[1].media_features and out[0].media_features.payload_bytes == 64


# ---- toxicity


def plain_features(text, lexicon):
    words = re.findall(r"[^\W_][\w@$*]*", text.lower())

    def worth(w):
        forms = {w, w.translate(toxicity.LEET).replace("*", "")}
        values = [lexicon.get(x, 0.0) for x in forms] + [lexicon.get(x[:k] + "-", 0.0) for x in forms for k in toxicity.STEMS]
        return max([*values, *([lexicon.get("", 5.0)] if forms & toxicity.INSULTS else [])])

    n, value = max(1, len(words)), [worth(w) for w in words]
    at, you = [i for i, v in enumerate(value) if v], [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    odd = [w for w in dict.fromkeys(words) if not w.isalpha() and not w.isdigit() and any(c.isalpha() for c in w)]
    insults = [words[i] for i in at if words[i] in toxicity.INSULTS]
    raw = text.encode()
    size, count = max(1, len(raw)), lambda test: sum(1 for b in raw if b < 128 and test(chr(b)))
    upper, lower = count(str.isupper), count(str.islower)
    return [
        len(at) / n, float(len(at)), max((value[i] for i in at), default=0.0), sum(value) / n, sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in at) / n, len(you) / n, upper / max(1, upper + lower),
        text.count("!") / size, text.count("?") / size, count(lambda c: c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") / size, count(str.isdigit) / size, len(odd) / n, float(sum(worth(w) > 0 for w in odd)), len(insults) / n, float(len(insults)), float(np.log1p(n)),
    ]


def test_text_features_are_plain():
    rng, lexicon = random.Random(6), {"foul": 3.0, "rott-": 2.5, "stinker": 4.0}
    parts = ["you", "Your", "FOUL", "f0ul", "rotten", "rott3r", "st1nker", "idiot", "1d1ot", "id*iot", "nice", "été", "12", "a1", "!", "?", "...", "_x", "$$", "\n"]
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))
        have = toxicity.text_features(text, toxicity.Weights(lexicon), toxicity.word_pattern().findall)
        assert have == pytest.approx(plain_features(text, lexicon))
    assert len(toxicity.NAMES) == len(plain_features("", lexicon))


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    return toxicity.train(docs, labels)


def test_trained_toxicity_odd(docs, empty, toxic_model):
    assert toxic_model.trees is not None
    marked = docs.withColumns({"toxicity": F.lit("clash"), "features": F.lit("clash"), "probability": F.lit(1), "prediction": F.lit("x"), "raw": F.lit(2)})
    out = toxicity.score(marked, toxic_model)
    assert out.count() == docs.count() and set(out.columns) == set(marked.columns)
    rows = out.collect()
    assert all(0 <= r.toxicity <= 1 and (r.features, r.probability, r.prediction, r.raw) == ("clash", 1, "x", 2) for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(r.toxicity)
    assert all(len(s) == 1 for s in by_text.values())
    assert toxicity.reject_toxic(marked, toxic_model).columns == marked.columns
    assert toxicity.score(empty, toxic_model).count() == 0


def test_calibration_is_isotonic(spark, toxic_model):
    """Scores rise with the trees' own probability, and are the calibration's line between its knots."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    measured = toxicity.add_features(docs, toxic_model.lexicon, "text", "x").withColumn("features", array_to_vector("x"))
    raw = {r.doc_id: r.raw for r in toxic_model.trees.transform(measured).select("doc_id", vector_to_array("probability")[1].alias("raw")).collect()}
    have = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxic_model).collect()}
    knots, values = toxic_model.calibration.boundaries.toArray(), toxic_model.calibration.predictions.toArray()
    assert all(have[d] == pytest.approx(min(1, max(0, (1 - toxicity.RAW) * float(np.interp(raw[d], knots, values)) + toxicity.RAW * raw[d]))) for d in raw)
    assert (np.diff(values) >= 0).all()


# ---- language


def plain_vote(v, model):
    """Family, then language: most pairwise wins, ties to what the sums of beliefs say."""

    def wins(group, members):
        if len(members) == 1:
            return members[0]
        score = dict.fromkeys(members, 0.0)
        for a, b in combinations(sorted(members), 2):
            w = np.frombuffer(model["pairs"][(group, a, b)], np.float32)
            m = float(v @ w[:-1] + w[-1])
            p = 1 / (1 + np.exp(-np.clip(3 * m, -30, 30)))
            score[a] += (m >= 0) + 1e-3 * p
            score[b] += (m < 0) + 1e-3 * (1 - p)
        return max(members, key=lambda x: (score[x], x))

    family = wins("family", model["families"])
    return wins(family, [x for x in model["langs"] if language.family_of(x) == family])


def test_trained_language_odd(spark, docs, empty):
    model = language.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert model["pairs"]
    marked = docs.withColumns({"lang_pred": F.lit("clash"), "score": F.lit("kept")})
    rows = language.identify(marked, model).collect()
    assert len(rows) == docs.count() and all(r.score == "kept" and 0 <= r.lang_score <= 1 for r in rows)
    for r in rows:
        v = language.features(r.text) if r.text else None
        assert r.lang_pred == ("und" if v is None else plain_vote(v, model))
    odd = ["١٢٣", "०१२", "１２", "́", "،؛", "№ 12", "ª", "µ", "º", "я", "字"]
    got = [r.lang_pred for r in language.identify(spark.createDataFrame([(x,) for x in odd], "text string"), model).collect()]
    assert [g == "und" for g in got] == [not any(c.isalpha() for c in x) for x in odd]
    assert language.identify(empty, model).count() == 0


def test_language_features_are_plain():
    for text in ("Hello, wörld 12", "a", "  x-y  ", "日本 ab", "ﬁne ª"):
        letters = [c if c.isalpha() else " " for c in text.lower()]
        total = np.zeros(language.DIM)
        c = [np.uint32(ord(x)) * np.uint32(2654435761) for x in [" ", *letters, " "]]
        with np.errstate(over="ignore"):
            two = [a * np.uint32(31) + b for a, b in zip(c, c[1:])]
            three = [a * np.uint32(31) + b for a, b in zip(two, c[2:])]
            for grams, seed in ((c[1:-1], 0x9E37), (two, 0x85EB), (three, 0xC2B2)):
                for g in grams:
                    h = (g ^ np.uint32(seed)) * np.uint32(2246822519)
                    total[(h ^ h >> np.uint32(15)) & np.uint32(language.DIM - 1)] += 1
        want = np.sqrt(total) / np.linalg.norm(np.sqrt(total))
        assert np.allclose(language.features(text), want, atol=1e-6)
    assert language.features("12 ٣ ́") is None


def test_language_sample_is_the_smallest_hashes(spark, monkeypatch):
    """Of each language the texts of the smallest hashes are used, each once, however often one is repeated."""
    texts = [(f"words of number {k} here", "en" if k % 2 else "fr") for k in range(300)] + [("one copy", "en")] * 500
    df = spark.createDataFrame(texts, "text string, lang string")
    kept = {}
    monkeypatch.setattr(language, "settled", lambda rows, name: kept.setdefault(name, rows))
    language.train(df, sample=20)
    rows = df.distinct().withColumn("h", F.xxhash64("text")).collect()
    want = {(x, r.text) for x in ("en", "fr") for r in sorted((r for r in rows if r.lang == x), key=lambda r: r.h)[:20]}
    assert {(r.lang, r.text) for r in kept["language-sample"].collect()} == want


# ---- URLs


def plain_hits(url, vocabulary):
    text = (url or "").lower() if (url or "").isascii() else "".join(c.lower() if c.isascii() else c for c in url or "")
    for code, c in url_filter._CODES:
        text = text.replace(code, c)
    return {t for t in vocabulary if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", text)}


def test_url_terms_are_plain(spark):
    rng = random.Random(7)
    words = [*rng.sample(url_filter.STRICT, 8), *rng.sample(url_filter.SOFT, 20), "p%6Frn", "%78%78%78", "h%4Ft", "é", "Ärger", "shop", "12", "%zz", "%", "%%361", "ﬁ", "İ"]
    urls = ["http://" + "".join(rng.choice(words) + rng.choice([".", "/", "-", "", "?", "x", "%2F", " "]) for _ in range(rng.randrange(1, 9))) for _ in range(600)]
    urls += [None, "", "porn", "http://a.net/" + "x/" * 300_000 + "porn", urls[0], urls[0]]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumns({"url_terms": F.lit("kept"), "url_weight": F.lit("replaced")})
    out = url_filter.filter_urls(df).orderBy("page_id").collect()
    for r in out:
        hits = plain_hits(r.url, url_filter.VOCABULARY)
        assert (r.url_strict, r.url_soft, r.url_terms) == (len(hits & set(url_filter.STRICT)), len(hits & set(url_filter.SOFT)), "kept")
        assert r.url_weight == sum(url_filter.VOCABULARY[t] for t in hits)
        if r.url_rule is None:
            assert r.url_verdict == ("block" if r.url_strict or r.url_soft >= 2 else "allow")
    none = url_filter.filter_urls(df, vocabulary={}, rules=()).collect()
    assert {(r.url_verdict, r.url_weight) for r in none} == {("allow", 0.0)}


def test_urls_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute("create view pages as select * from '/root/testdata/sf0.01/pages.parquet'")
    rel = con.sql(ORACLE_SQL["op4_url_filters"])
    have = op4_url_filters(spark, "/root/testdata/sf0.01").select(*rel.columns)
    assert sorted(map(tuple, have.collect()), key=repr) == sorted(rel.fetchall(), key=repr)
