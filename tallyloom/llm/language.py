"""Language identification in two steps: the family first, then one-versus-one linear SVMs inside it.

A text is its normalised counts of hashed character trigrams, bigrams and single letters over the
whole text.  A linear support vector machine for each pair of families votes on the family; one for
each pair of its languages, trained on that family's documents alone, votes on the language.  All
machines are fitted in parallel, one pair to a task, by averaged stochastic subgradient steps on the
hinge loss, from a bounded sample of labelled rows (``sample`` a language, those with the smallest
hash); everything else reads every row.

A letter is a character of a Unicode category L.  All other characters, digits and marks of any
script among them, count as blanks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN, settled

#: Families of languages by ISO code.  A language named nowhere here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr"),
}
DIM = 4096
SAMPLE = 800
#: Languages that are learned at most, and the distinct texts that one must have.
LANGUAGES, LEAST = 64, 3
EPOCHS, PENALTY = 12, 1e-5
UNKNOWN = "und"
#: Characters counted at a time.
STEP = 1 << 20


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), f"only {lang}")


_LETTERS: list = []


def letters():
    """bool[0x110000]: which code points are letters, by Unicode's categories; made once a process."""
    import numpy as np

    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def features(text: str):
    """float32[DIM] of unit length, or None if the text holds no letter: hashed counts of 1 to 3 letters, square-rooted.

    Everything that is no letter counts as one blank.
    """
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    total = np.zeros(DIM)
    seen = False
    for at in range(0, max(1, len(codes)), STEP):
        part = codes[max(0, at - 2) : at + STEP]
        letter = letters()[part]
        if not letter.any():
            continue
        seen = True
        c = np.where(letter, part, 32).astype(np.uint32)
        c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]]) * np.uint32(2654435761)
        two = c[:-1] * np.uint32(31) + c[1:]
        three = two[:-1] * np.uint32(31) + c[2:]
        for grams, seed in ((c[1:-1], 0x9E37), (two, 0x85EB), (three, 0xC2B2)):
            h = (grams ^ np.uint32(seed)) * np.uint32(2246822519)
            total += np.bincount((h ^ h >> np.uint32(15)) & np.uint32(DIM - 1), minlength=DIM)
    if not seen:
        return None
    out = np.sqrt(total)
    return (out / np.linalg.norm(out)).astype(np.float32)


def fit_pair(x, y, seed: int = 0):
    """Weights and bias (in the last place) of a linear SVM for rows ``x`` and labels +1 / -1."""
    import numpy as np

    rng = np.random.default_rng(seed)
    weight = np.where(y > 0, len(y) / 2 / max(1, (y > 0).sum()), len(y) / 2 / max(1, (y < 0).sum()))
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, mean, steps, batch = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 32
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            steps += 1
            rate = 4.0 / (1 + 0.01 * steps)
            inside = y[rows] * (x[rows] @ w) < 1
            w *= 1 - rate * PENALTY
            w += rate / len(rows) * ((weight[rows] * y[rows] * inside) @ x[rows])
            if epoch >= EPOCHS // 2:
                mean += w
    return (mean / (EPOCHS - EPOCHS // 2) / -(-len(x) // batch)).astype(np.float32)


def hash_bound(share: float) -> int:
    """The 64-bit hash up to which about ``share`` of all hashes lie."""
    return min((1 << 63) - 1, -(1 << 63) + int(min(1.0, share) * (1 << 64)))


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES, least: int = LEAST) -> dict:
    """The model, from rows with a text and a non-null language.

    ``sample`` distinct texts of each language, those with the smallest hash, are used; repeated texts
    count once.  Texts without a letter teach nothing.  With no usable row the model is empty and
    knows no language; with one language it always answers that.

    Learned are the ``languages`` languages of the most distinct texts, among equals the first by code, of those with at
    least ``least``; other values of the column, such as misspelt codes, are never answered.  A machine
    between two families takes of each family as many texts as two languages have, spread evenly over its languages,
    so no machine's rows grow with the number of languages.

    A language's number of texts gives the hash below which about twice the sample lies; only texts
    below it are ranked, so no language, whatever its share of the rows, fills a task.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where("text is not null and lang is not null").withColumn("h", F.xxhash64("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "lang").limit(languages).collect()
    within = F.lit(False)
    for r in counts:
        within = within | ((F.col("lang") == r.lang) & (F.col("h") <= hash_bound((2 * sample + 200) / max(1, r.n))))
    smallest = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    near = rows.where(within).groupBy("lang", "h").agg(F.first("text").alias("text"))
    chosen = settled(near.withColumn("k", smallest).where(F.col("k") <= sample), "language-sample")
    langs = sorted(r.lang for r in counts)
    families = sorted({family_of(x) for x in langs})
    pairs = [("family", *p) for p in combinations(families, 2)] + [(f, *p) for f in families for p in combinations([x for x in langs if family_of(x) == f], 2)]
    if not pairs:
        return {"langs": langs, "families": families, "pairs": {}}
    member = {p: {x: (family_of(x) if p[0] == "family" else x) for x in langs} for p in pairs}
    held = {f: sum(family_of(x) == f for x in langs) for f in families}
    most = lambda p, x: min(sample, max(1, 2 * sample // held[family_of(x)])) if p[0] == "family" else sample
    sides = [(p_id, x, 1 if member[p][x] == p[1] else -1, most(p, x)) for p_id, p in enumerate(pairs) for x in langs if member[p][x] in p[1:]]

    def vectors(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [(x, h, k, v.tobytes()) for x, h, t, k in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "text", "k"))) if (v := features(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], kind) for c, kind in enumerate((pa.string(), pa.int64(), pa.int32(), pa.binary()))], ["lang", "h", "k", "v"])

    def fit(key, pdf):
        import numpy as np

        pdf = pdf.sort_values(["lang", "h"])
        return pd.DataFrame({"pair": [key[0]], "w": [fit_pair(np.stack([np.frombuffer(v, np.float32) for v in pdf["v"]]), pdf["side"].to_numpy(np.float64)).tobytes()]})

    chosen = chosen.select("lang", "h", "text", "k").mapInArrow(vectors, "lang string, h long, k int, v binary")
    by_pair = chosen.join(labelled.sparkSession.createDataFrame(sides, "pair int, lang string, side int, most int"), "lang").where("k <= most").select("pair", "lang", "h", "side", "v")
    fitted = by_pair.groupBy("pair").applyInPandas(fit, "pair int, w binary").collect()  # a row a pair of languages
    return {"langs": langs, "families": families, "pairs": {pairs[r.pair]: bytes(r.w) for r in fitted}}


def predict(text: Column, model: dict) -> Column:
    """struct(lang string, score double) for a text column; ``und`` with score 0 where no letter is, or nothing was learned."""

    @F.pandas_udf("lang string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import numpy as np

        langs, families = model["langs"], model["families"]
        names = list(model["pairs"])
        weights = np.stack([np.frombuffer(model["pairs"][n], np.float32) for n in names]) if names else np.zeros((0, DIM + 1), np.float32)

        def vote(group: str, members: list[str], margins) -> tuple[str, float]:
            if len(members) == 1:
                return members[0], 1.0
            votes, belief = dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
            for (g, a, b), m in zip(names, margins):
                if g == group:
                    p = 1 / (1 + np.exp(-np.clip(3.0 * m, -30, 30)))
                    votes[a], votes[b] = votes[a] + (m >= 0) + 1e-3 * p, votes[b] + (m < 0) + 1e-3 * (1 - p)
                    belief[a], belief[b] = min(belief[a], p), min(belief[b], 1 - p)
            best = max(members, key=lambda x: (votes[x], x))
            return best, float(belief[best])

        for texts in batches:
            found = [features(t) if t else None for t in texts]
            out = []
            for v in found:
                if v is None or not langs:
                    out.append((UNKNOWN, 0.0))
                    continue
                margins = weights[:, :-1] @ v + weights[:, -1]
                family, p = vote("family", families, margins)
                lang, q = vote(family, [x for x in langs if family_of(x) == family], margins)
                out.append((lang, p * q))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return judge(text.cast("string"))


def identify(docs: DataFrame, model: dict, *, text: str = "text", to: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1).

    Every row stays, repeated ones and null ids too, and texts of any length are read whole; columns
    of these names are replaced, all others kept.  Null and empty texts, and texts without a letter,
    are ``und`` with score 0.  An empty table gives no rows.
    """
    own = f"{OWN}lang"
    return docs.withColumn(own, predict(F.col(f"`{text}`"), model)).withColumn(to, F.col(f"{own}.lang")).withColumn(score, F.col(f"{own}.score")).drop(own)
