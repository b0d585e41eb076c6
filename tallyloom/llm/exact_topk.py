"""Exact search for the largest integer inner products, by three phases with a uniform threshold.

A vector's dimensions are cut into ``SLICES`` slices.  Each slice is a list of its own: for a query it
knows the part of every vector's score that its dimensions give, and a score is the sum of its parts.

1. Each slice gives its best parts a query (``FROM_BLOCK`` of a block, ``GATHERED`` in all).  Their
   vectors' scores are computed exactly, and the k-th largest is a score that k vectors are known to reach.
2. Each slice is sent that score as its queries' cutoff and gives every part that, times the number of
   slices, reaches it.  A vector none of whose parts does so scores less than the cutoff, so no vector
   of the result is missed.  The parts seen, and the most that the slices that did not give one can add,
   bound a score from above; vectors that all slices gave are known exactly and raise the cutoff.
3. Vectors whose bound reaches the raised cutoff are resolved exactly.

Vectors lie in blocks and queries in chunks, of bounded size, and a task holds a block and a chunk, or
a slice of both.  Of equal vectors only the k + 1 of the smallest ids can be in a result, as ties go to
the smaller id, so a vector that a third of the rows repeat is k + 1 rows.  All arithmetic is on integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled

SLICES = 2
#: Parts that a slice gives a query in the first phase: from a block, and in all.
FROM_BLOCK, GATHERED = 8, 128
#: Vectors in a block and queries in a chunk, on average; pairs of them whose parts are held at a time.
BLOCK, CHUNK, PAIRS = 4096, 4096, 1 << 21
#: The cutoff of a query that wants all: it lies below every sum of parts.
ALL = -(2**62)

_KEYS = ("dim", "block", "chunk")
_PAIR = "asked long, query_id long, row long, id long, dim int, block int, chunk int"


def finite(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole(vectors: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """(id, dim, v): rows whose components are all finite, once each, with each component x as floor(scale * x)."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where("id is not null").where(finite(F.col("v")))
    too_large = F.raise_error(F.lit("a component times the scale is beyond 53 bits")).cast("long")
    unit = F.transform("v", lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale)).otherwise(too_large))
    return rows.select("id", F.size("v").alias("dim"), unit.alias("v")).distinct()


def dealt(rows: DataFrame, part: str, size: int) -> DataFrame:
    """``rows`` numbered, and with the number ``part`` of their share of about ``size`` rows of one length."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("n"))  # a row a length of vectors
    return settled(rows.join(counts, "dim").select("id", "dim", "v", F.monotonically_increasing_id().alias("row"), F.pmod(F.xxhash64("id", F.lit(size)), "n").cast("int").alias(part)), f"topk-{part}")


def checked(out, most: int):
    """``out``, no element of which may pass 61 bits; ``most`` bounds them."""
    if most >= 2**61 and (abs(out) >= 2**61).any():
        raise OverflowError("a part of a score is beyond 61 bits")
    return out


def largest(v, q) -> int:
    return v.shape[1] * int(abs(v).max()) * int(abs(q).max()) if v.size and q.size else 0


def products(v, q):
    """Inner products, a row a query: in doubles where they hold every sum exactly, else in 64-bit or, beyond those, in Python's integers."""
    most = largest(v, q)
    if most < 2**53:
        return (q.astype(float) @ v.T.astype(float)).astype("int64")
    return checked(q @ v.T if most < 2**63 else q.astype(object) @ v.T.astype(object), most)


def pairwise(v, q):
    """Inner products of the rows of ``v`` with those of ``q`` in turn."""
    most = largest(v, q)
    return checked((v * q).sum(axis=1) if most < 2**63 else (v.astype(object) * q.astype(object)).sum(axis=1), most)


def stacked(pdf):
    import numpy as np

    return np.stack(pdf["v"].to_list()).astype(np.int64).reshape(len(pdf), -1)


def met(vectors: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each vector once for each chunk of queries, and each query once for each block of vectors."""
    blocks, chunks = vectors.select("dim", "block").distinct().toDF("dim", "block"), queries.select("dim", "chunk").distinct().toDF("dim", "chunk")
    return vectors.join(chunks, "dim"), queries.join(blocks, "dim")


def sliced(rows: DataFrame, slices: int) -> DataFrame:
    """A row for each of a vector's slices; lengths of slices differ by one at most."""
    cut = lambda n: F.floor(F.col("dim") * n / slices).cast("int")
    each = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return each.withColumn("v", F.slice("v", cut(F.col("slice")) + 1, cut(F.col("slice") + 1) - cut(F.col("slice"))))


def listed(vectors: DataFrame, queries: DataFrame, slices: int, best: int | None) -> DataFrame:
    """Parts of scores: each block's ``best`` a query and slice, or (None) those that, times ``slices``, reach the query's ``cutoff``.

    A vector of the query's own id is passed over.
    """
    left, right = (sliced(x, slices) for x in met(vectors, queries))

    def run(key, block, asked):
        import numpy as np
        import pandas as pd

        found = [np.empty((5, 0), np.int64)]
        if len(block) and len(asked):
            rows, ids, asked_rows, qids = (x[c].to_numpy() for x in (block, asked) for c in ("row", "id"))
            v, q, cutoff = stacked(block), stacked(asked), asked["cutoff"].to_numpy()
            least = np.where(cutoff == ALL, ALL, -(-cutoff // slices))
            step = max(1, PAIRS // len(block))
            for at in range(0, len(asked), step):
                parts = products(v, q[at : at + step])
                other = ids[None, :] != qids[at : at + step, None]
                if best is None:
                    i, j = np.nonzero(other & (parts >= least[at : at + step, None]))
                else:
                    take = min(best + 1, len(block))  # one more, as the query itself may be among them
                    top = np.argpartition(parts, len(block) - take, axis=1)[:, len(block) - take :]
                    i, place = np.nonzero(np.take_along_axis(other, top, axis=1))
                    j = top[i, place]
                found.append(np.stack([asked_rows[at + i], qids[at + i], rows[j], ids[j], parts[i, j].astype(np.int64)]))
        out = np.concatenate(found, axis=1)
        columns = dict(zip(("asked", "query_id", "row", "id"), out)) | {k: np.int32(x) for k, x in zip((*_KEYS, "slice"), key)}
        return pd.DataFrame(columns | {"part": out[4]})

    keys = (*_KEYS, "slice")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, f"{_PAIR}, slice int, part long")


def resolved(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, id, score) of pairs of rows, exactly; of several vectors under one id the best counts."""
    left, right = met(vectors, queries)
    sent = right.select("dim", "block", "chunk", F.col("row").alias("asked"), "v").unionByName(pairs.select(*_KEYS, "asked", "query_id", "row", "id"), allowMissingColumns=True)

    def run(block, asked):
        import numpy as np
        import pandas as pd

        wanted = asked[asked["v"].isna()]
        if not len(wanted):
            return pd.DataFrame({"query_id": [], "id": [], "score": []}).astype(np.int64)
        block, asked = block.sort_values("row"), asked[asked["v"].notna()].sort_values("asked")
        v, q, out = stacked(block), stacked(asked), []
        i = np.searchsorted(block["row"].to_numpy(), wanted["row"].to_numpy(np.int64))
        j = np.searchsorted(asked["asked"].to_numpy(), wanted["asked"].to_numpy())
        step = max(1, PAIRS // max(1, v.shape[1]))
        for at in range(0, len(wanted), step):
            out.append(pairwise(v[i[at : at + step]], q[j[at : at + step]]))
        return pd.DataFrame({"query_id": wanted["query_id"].to_numpy(np.int64), "id": wanted["id"].to_numpy(np.int64), "score": np.concatenate(out).astype(np.int64)})

    return best_by_id(left.groupBy(*_KEYS).cogroup(sent.groupBy(*_KEYS)).applyInPandas(run, "query_id long, id long, score long"))


def best_by_id(scores: DataFrame) -> DataFrame:
    return scores.groupBy("query_id", "id").agg(F.max("score").alias("score"))


def ranked(scores: DataFrame, k: int) -> DataFrame:
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scores.withColumn("rank", best).where(F.col("rank") <= k)


def reached(scores: DataFrame, k: int, name: str) -> DataFrame:
    """(query_id, ``name``): the k-th largest score of each query that has k."""
    return ranked(scores, k).where(F.col("rank") == k).select("query_id", F.col("score").alias(name))


def top_k(vectors: DataFrame, *, queries: DataFrame | None = None, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, scale: float = 256.0, slices: int = SLICES) -> DataFrame:
    """(query_id, rank, id, score): for each query the k vectors of the largest inner product, ties to the smaller id.

    Components become floor(scale * x).  ``queries`` are rows of the same columns; by default those of
    ``vectors`` whose id is divisible by ``every``.  Vectors that are null or hold a null or non-finite
    component take no part, nor do null ids; zero and empty vectors do.  Vectors of other lengths than
    the query's are never compared.  Rows that repeat an id and a vector count once; rows of the query's
    own id are passed over, and of several vectors under one id the best counts.  Columns other than
    these two play no part.  With no more than k candidates all are returned; empty tables give no rows.
    A component of over 53 bits, or a part of a score of over 61, is an error.
    """
    return search(vectors, queries, id_col, vector, k, every, scale, slices)[0]


def search(vectors: DataFrame, queries: DataFrame | None, id_col: str, vector: str, k: int, every: int, scale: float, slices: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``top_k``, the parts that the second phase collected, and the scores that the third resolved."""
    rows = settled(whole(vectors, id_col, vector, scale), "topk-whole")
    asked = rows.where(F.pmod("id", F.lit(every)) == 0) if queries is None else whole(queries, id_col, vector, scale)
    asked = dealt(asked, "chunk", CHUNK)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    base = dealt(rows.withColumn("place", place).where(F.col("place") <= k + 1), "block", BLOCK)

    best = F.row_number().over(Window.partitionBy("asked", "slice").orderBy(F.desc("part"), "row"))
    lists = listed(base, asked.withColumn("cutoff", F.lit(ALL)), slices, max(k, FROM_BLOCK))
    first = lists.withColumn("place", best).where(F.col("place") <= max(k, GATHERED)).drop("place", "slice", "part").distinct()
    cutoffs = settled(reached(resolved(first, base, asked), k, "cutoff"), "topk-cutoffs")
    sent = settled(asked.join(cutoffs, F.col("id") == F.col("query_id"), "left").drop("query_id").na.fill(ALL, ["cutoff"]), "topk-sent")
    collected = settled(listed(base, sent, slices, None), "topk-collected")

    seen = collected.groupBy(*(c.split()[0] for c in _PAIR.split(", "))).agg(F.sum("part").alias("seen"), F.count("*").alias("lists"))
    held = settled(seen.join(cutoffs, "query_id", "left"), "topk-held")
    raised = reached(best_by_id(held.where(F.col("lists") == slices).select("query_id", "id", F.col("seen").alias("score"))), k, "raised")
    # a part that a slice did not give is below its share of the cutoff
    share = F.expr(f"(cutoff + pmod(-cutoff, {slices})) div {slices}") - 1  # rounded up, less one
    most = F.col("seen") + (slices - F.col("lists")) * share
    left = held.join(raised, "query_id", "left").where(F.col("cutoff").isNull() | (most >= F.greatest("cutoff", "raised")))
    scores = settled(resolved(left, base, asked), "topk-resolved")
    return ranked(scores, k).select("query_id", "rank", "id", "score"), collected, scores


def oracle(k: int = 5, every: int = 50) -> str:
    """DuckDB SQL of ``top_k`` over ``embeddings``."""
    return f"""
with fine as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, max(list_inner_product(q.v, c.v)::bigint) as score
  from fine q join fine c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % {every} = 0 group by all)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= {k}"""
