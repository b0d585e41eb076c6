"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The features of a whole text are rates: lexicon hits, hits near a word of the second person,
capitals, punctuation and obfuscated words.  The lexicon is a short fixed list and, beside it, the
words and word beginnings that the labelled rows show to be far more frequent in toxic texts.
All is learned from a bounded sample of the labelled rows (about ``sample`` a class, by hash) in two
halves.  The trees see each half through the lexicon of the other half, so that they learn what the
lexicon's hits are worth on texts it was not made from; the calibration sees each half's scores by
trees of the other half alone, so that it learns what a score is worth on texts no tree was fitted
to.  The trees and the lexicon in use are then those of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN, settled

#: Insults, and words of the second person in four languages.
INSULTS = frozenset("idiot stupid moron scum trash loser pathetic worthless disgusting clown".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tú usted ustedes vosotros tus".split())
#: Characters written for letters.
LEET = str.maketrans("013457@$", "oieastas")
SAMPLE, LEXICON = 6000, 2000
#: Word beginnings that the lexicon may hold, by length.
STEMS = (8, 7, 6, 5, 4, 3)
TREES, DEPTH, NEAR = 20, 3, 5
THRESHOLD = 0.7
#: Share of the trees' own probability in a score, so that texts on one step of the calibration keep their order.
RAW = 0.02
NAMES = ("hit_rate", "hits", "top_weight", "weight_rate", "near_rate", "second_rate", "capital_rate", "bang_rate", "question_rate", "punctuation_rate", "digit_rate", "obfuscated_rate", "obfuscated_hits", "insult_rate", "insults", "length")


def word_pattern():
    import re

    return re.compile(r"[^\W_][\w@$*]*")


class Weights(dict):
    """Word -> its lexicon weight, 0.0 if it has none; looked up once a word and kept up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        plain = word.translate(LEET).replace("*", "")
        found = [self.lexicon.get(w, 0.0) for w in {word, plain}] + [self.lexicon.get(f"{w[:k]}-", 0.0) for w in {word, plain} for k in STEMS]
        if word in INSULTS or plain in INSULTS:
            found.append(self.lexicon.get("", 5.0))
        self[word] = best = max(found)
        return best


def text_features(text: str, weights: Weights, find) -> list[float]:
    import math

    import numpy as np

    words = find(text.lower())
    n = max(1, len(words))
    values = list(map(weights.__getitem__, words))
    at = [i for i, v in enumerate(values) if v] if any(values) else []
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if at and you:
        spots = np.array(you)
        near = int((np.abs(np.array(at)[:, None] - spots[np.clip(np.searchsorted(spots, at)[:, None] + [-1, 0], 0, len(spots) - 1)]) <= NEAR).any(axis=1).sum())
    odd = [w for w in set(words) if not w.isalpha() and not w.isdigit() and any(c.isalpha() for c in w)]
    insults = [words[i] for i in at if words[i] in INSULTS]
    octets = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, int(octets.sum()))
    upper, lower = int(octets[65:91].sum()), int(octets[97:123].sum())
    punctuation = int(octets[33:48].sum() + octets[58:65].sum() + octets[91:97].sum() + octets[123:127].sum())
    return [
        len(at) / n, float(len(at)), max((values[i] for i in at), default=0.0), sum(values) / n, near / n, len(you) / n, upper / max(1, upper + lower), octets[33] / size, octets[63] / size,
        punctuation / size, int(octets[48:58].sum()) / size, len(odd) / n, float(sum(weights[w] > 0 for w in odd)), len(insults) / n, float(len(insults)), math.log1p(n),
    ]


def add_features(docs: DataFrame, lexicon: dict[str, float], text: str, to: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, find = Weights(lexicon), word_pattern().findall
        for texts in batches:
            yield pd.Series([text_features(t or "", weights, find) for t in texts], dtype=object)

    return docs.withColumn(to, measure(F.col(f"`{text}`").cast("string")))


@dataclass
class Model:
    """A fitted scorer; without ``trees`` every text scores ``constant``."""

    lexicon: dict[str, float]
    trees: Any = None
    calibration: Any = None
    constant: float = 0.0


def learn_lexicon(rows: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """The ``LEXICON`` words and beginnings (written with a hyphen) of largest log-odds among those in a hundredth of the toxic texts, and 3 or more."""

    def tokens(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa

        find = word_pattern().findall
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(find((t or "").lower()))
                counts[y].update(words | {f"{w[:k]}-" for w in words for k in STEMS if len(w) >= k})
            rows = [(w, n if y else 0, 0 if y else n) for y, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["word", "bad", "good"])

    counts = rows.select("text", "toxic").mapInArrow(tokens, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1.0)) - F.log((F.col("good") + 0.5) / (clean + 1.0))
    top = counts.where((F.col("bad") >= max(3, 0.01 * toxic)) & (F.col("good") <= 0.004 * clean)).withColumn("odds", odds).where(F.col("odds") >= 2.0)
    return {r.word: r.odds for r in top.orderBy(F.desc("odds"), "word").limit(LEXICON).collect()}  # the bound is the lexicon's size


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from the texts of ``docs`` that ``labels`` (id, 0 or 1) covers.

    About ``sample`` rows a class are used, all of a smaller class: those whose id's hash lies below
    the class's share of the hashes, so nothing is ranked and no class fills a task.  An id labelled
    twice is toxic if one label says so; null labels and ids are skipped, and of several texts of an
    id one is used.  Without labelled texts every score is 0; with one class, that class.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic")).where("id is not null and toxic is not null").groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    hashed = lambda salt: F.crc32(F.concat(F.lit(salt), F.col("id").cast("string")))
    share = F.when(F.col("toxic") == 1, sample / max(1, totals.get(1, 0))).otherwise(sample / max(1, totals.get(0, 0)))
    picked = marks.where(hashed("t") < share * 2.0**32).withColumn("half", F.pmod(hashed("h"), F.lit(2)))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "id")  # about ``sample`` rows a class
    rows = settled(found.dropDuplicates(["id"]).select("text", "toxic", "half"), "toxicity-sample")
    sizes = {(r.half, r.toxic): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    seen = {y: sum(n for (_, t), n in sizes.items() if t == y) for y in (0, 1)}
    if not seen[0] or not seen[1]:
        return Model({}, constant=float(seen[1] > 0))
    weight = F.when(F.col("toxic") == 1, totals[1] / seen[1]).otherwise(totals[0] / seen[0])
    half = lambda k: rows.where(F.col("half") == k)
    across = [add_features(half(k), learn_lexicon(half(1 - k), sizes.get((1 - k, 1), 0), sizes.get((1 - k, 0), 0)), "text", "x") for k in (0, 1)]
    measured = settled(across[0].unionByName(across[1]).select("half", F.col("toxic").cast("double").alias("toxic"), weight.alias("weight"), "x"), "toxicity-features")
    vectors = measured.withColumn("features", array_to_vector("x")).drop("x")
    grow = GBTClassifier(labelCol="toxic", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7)

    def outside(k: int) -> DataFrame:
        """Half ``k`` scored by trees of the other half."""
        mine, others = vectors.where(F.col("half") == k), vectors.where(F.col("half") == 1 - k)
        if not sizes.get((1 - k, 0)) or not sizes.get((1 - k, 1)):  # a half of one class has no trees; it says that class
            return mine.select("toxic", "weight", F.lit(float(sizes.get((1 - k, 1), 0) > 0)).alias("raw"))
        return grow.fit(others).transform(mine).select("toxic", "weight", vector_to_array("probability")[1].alias("raw"))

    scored = settled(outside(0).unionByName(outside(1)), "toxicity-outside")
    calibration = IsotonicRegression(labelCol="toxic", weightCol="weight", featuresCol="raw", predictionCol="score").fit(scored)
    return Model(learn_lexicon(rows, seen[1], seen[0]), grow.fit(vectors), calibration)


def score(docs: DataFrame, model: Model, *, text: str = "text", to: str = "toxicity") -> DataFrame:
    """``docs`` and the score ``to``, from 0 to 1.

    Null texts score as empty ones, texts of any length are read whole, equal texts score alike.  Every
    row stays, repeated ones and null ids too; a column already named ``to`` is replaced, all others
    kept.  An empty table gives no rows.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if model.trees is None:
        return docs.withColumn(to, F.lit(model.constant))
    x, raw = f"{OWN}features", f"{OWN}raw"
    own = {"featuresCol": x, "predictionCol": f"{OWN}p", "probabilityCol": f"{OWN}q", "rawPredictionCol": f"{OWN}r"}
    trees = model.trees.copy().setFeaturesCol(x).setPredictionCol(own["predictionCol"]).setProbabilityCol(own["probabilityCol"]).setRawPredictionCol(own["rawPredictionCol"])
    calibration = model.calibration.copy().setFeaturesCol(raw).setPredictionCol(f"{OWN}score")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != to]
    measured = add_features(docs, model.lexicon, text, x).withColumn(x, array_to_vector(x))
    judged = calibration.transform(trees.transform(measured).withColumn(raw, vector_to_array(f"{OWN}q")[1]))
    return judged.select(*kept, F.least(F.greatest((1 - RAW) * F.col(f"{OWN}score") + RAW * F.col(raw), F.lit(0.0)), F.lit(1.0)).alias(to))


def reject_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns."""
    own = f"{OWN}toxicity"
    return score(docs, model, text=text, to=own).where(F.col(own) < threshold).drop(own)
