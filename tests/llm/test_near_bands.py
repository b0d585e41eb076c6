"""A pair is looked for in the first bucket that it truly shares."""

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import near_dedup


def low_bit_pairs(n=1500):
    """Pairs of texts that agree on 8 bits of a whole band before the first band whose bucket they share."""
    hashes, texts = near_dedup.WordHashes(), []
    for k in range(n):
        words = [f"w{k}x{j}" for j in range(64)]
        texts += [" ".join(words), " ".join([*words[:30], f"other{k}", *words[31:]])]
    sets = [near_dedup.shingles(t, hashes)[0] for t in texts]
    sig = near_dedup.signatures(np.concatenate(sets), np.ones(sum(map(len, sets))), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets), near_dedup.BANDS * near_dedup.ROWS)
    keys, low = near_dedup.buckets(sig), (sig & np.uint64(0xFF)).reshape(len(sig), near_dedup.BANDS, near_dedup.ROWS)
    true, chance = keys[::2] == keys[1::2], (low[::2] == low[1::2]).all(axis=2)
    return [(texts[2 * k], texts[2 * k + 1]) for k in np.flatnonzero(true.any(axis=1) & (chance.argmax(axis=1) < true.argmax(axis=1)))]


def test_chance_match_of_an_earlier_band(spark):
    found = low_bit_pairs()
    assert found
    rows = [(2 * k + side, pair[side]) for k, pair in enumerate(found) for side in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = near_dedup.signed(docs, "text", "distinct").select("t", F.col("t").alias("c"), "sig", F.posexplode("bands").alias("band", "bucket"))
    close = near_dedup.close_members(signed.select("t", "band", "bucket", "c", "sig"), near_dedup.LEAST_AGREEMENT)
    assert close.select("t").distinct().count() == len(rows)
