"""The source audit against brute force: odd rows and characters, documents of many blocks, sources of many tiles."""

import re
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import divergence

SCHEMA = "lang string, source string, text string, value bigint, term string"


def brute(rows, least=10, top=10):
    lower = str.maketrans(divergence.UPPER, divergence.LOWER)
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower)))) for lang, source, text in rows]
    df, counts, langs = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        counts[lang, source] += words
        langs[lang] += words
        df.update((lang, w) for w in words)
    out = set()

    def p(words, kept, w):
        return 1 + 10**9 * (words[w] + 2) // (sum(words[x] for x in kept) + 2 * len(kept))

    def placed(lang, source, part, items):
        return [(lang, source, part, item, value, r) for r, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1)]

    for lang in langs:
        kept = {w for (la, w), n in df.items() if la == lang and n >= least}
        groups = {s: {w: p(c, kept, w) for w in kept} for (la, s), c in counts.items() if la == lang}
        whole = {w: p(langs[lang], kept, w) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, mine in groups.items():
            out.update(placed(lang, s, "pair", [(o, sum(f(mine[w], other[w]) for w in kept)) for o, other in groups.items() if o != s]))
            out.update(placed(lang, s, "term", [(w, f(mine[w], whole[w])) for w in kept if counts[lang, s][w] and mine[w] > whole[w]])[:top])
    return out


def found(spark, rows, **options):
    got = divergence.audit(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3), **options).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


ODD = [(None, None, None), ("en", None, ""), ("en", "s9", " \n\t "), (None, "s1", "word"), ("xx", "alone", "one two"), ("", "", "word word"), ("en", "s1", "a-b " * 20_000), ("en", "s1", "x" * 100_000)]
SAID = "The the THE, (the) café CAFÉ naïve joined don't a1b2c 中文 « quoted » _under_score_ e-mail@x.org [^b]racket {curly} tab\tnul\x00end \x85   \U0001f600"


def test_odd_rows(spark):
    rows = [("en", f"s{k % 4}", f"{SAID} number{k % 3} word{'s' * (k % 2)} common {'rare' * (k == 7)}") for k in range(40)]
    rows += [("fr", f"s{k % 2}", "le mot") for k in range(9)] + [("de", f"s{k % 3}", "das wort " * (k % 3)) for k in range(30)] + ODD + [("en", "s2", "the same row")] * 12
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, least=1, top=2) == brute(rows, 1, 2)


@pytest.mark.parametrize("run", [60, 1 << 25])
def test_parts_and_tiles(spark, monkeypatch, run):
    """Short runs of documents, several tiles of sources and of terms, and a source with a third of all rows."""
    monkeypatch.setattr(divergence, "RUN", run)
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 40)
    monkeypatch.setattr(divergence, "STEP", 7)
    rows = [("en", f"s{k % 10:02}" if k % 3 else "hot", " ".join(f"w{'abcdefghij'[(k * j) % 10]}{'klm'[j % 3]}{'.,!'[k % 3]}" for j in range(k % 17))) for k in range(400)]
    assert found(spark, rows, least=3) == brute(rows, 3)


def test_none(spark):
    assert found(spark, []) == set()
    assert found(spark, [("en", "a", ""), ("en", "b", None)]) == brute([("en", "a", ""), ("en", "b", None)]) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_steps_hold_what_they_must(spark, monkeypatch):
    """Chunks that are terms as they stand are not cut, terms that cannot reach ``least`` documents go, and the large steps free their shuffle files."""
    settled, steps, plans, frees, key = divergence.settled, {}, {}, set(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def seen(df, name):
        frees.update([name] if spark.conf.get(key, "false") == "true" else [])
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return steps.setdefault(name, settled(df, name))

    monkeypatch.setattr(divergence, "settled", seen)
    before = spark.conf.get(key, None)
    said = ["alone", "é\u0080", "alone-alone", "Alone,", "b", "b.", "(b)", "[", "12"]
    rows = [("en", f"s{k % 3}", f"{said[k % 9]} {said[k % 4]} rare{'abcdefghij'[k % 10]}{'xyz'[k % 3]} {said[k % 7]}") for k in range(40)]
    assert found(spark, rows) == brute(rows)
    assert "SortMergeJoin" in plans["divergence-unsure"] and "Broadcast" not in plans["divergence-unsure"]
    assert {r.chunk for r in steps["divergence-terms"].collect()} == {"alone-alone", "Alone,", "b.", "(b)"}
    assert {"divergence-counts", "divergence-bounds", "divergence-kept"} <= frees and spark.conf.get(key, None) == before
    kept = {(r.term, r.sure) for r in steps["divergence-bounds"].collect()}
    assert {t for t, _ in kept} == {"alone", "é\u0080", "b"} and {s for _, s in kept} == {True, False}
