"""Approximate nearest neighbours by collision counting over sorted projections.

Vectors are scaled to unit length and projected on ``PROJECTIONS`` random lines.  A block of vectors
holds one sorted array of projections a line.  A query opens a window centred on its own projection
on every line; a vector collides once for each line on which it lies in the window.  Vectors that
collide on at least ``THRESHOLD`` of the lines are candidates and are verified by their exact cosine in
double precision.  Windows widen by virtual rehashing, radius by radius from the same sorted arrays,
up to the distance of the k-th best that is known, which shrinks as candidates are verified.

Vectors lie in cells around pivots (a bounded sample, ``PIVOTS`` a length at most; every vector is
indexed), and a cell in blocks of bounded size.  A query first searches its own cell.  The k-th best
found there bounds its windows, and it is sent on only to cells whose range of projections those
windows meet on enough lines.  So a block's arrays are sorted once for the first search and once more
for each ``QUERIES`` queries that are sent to it.

Vectors of one direction are searched as one, with the ids of all that a result can take (the k + 1
smallest), so a result holds all of them or none.  Whatever may be among a block's k best is given one
cosine, of the original vectors in twice the double precision and rounded to a double: equal cosines
come out equal wherever they were found, and ties go by id.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled

PROJECTIONS, THRESHOLD, SEED = 256, 0.66, 20240229
#: Radii of a search, as shares of the distance of the k-th best known at its start.
RADII = (0.8, 0.87, 0.94, 1.0)
#: Vectors of a block that every query is compared with at first, so that a distance is known.
FIRST = 64
#: Cosines of double precision that are closer than this are compared in twice that precision.
SLACK = 1e-12
#: Vectors in a block and queries sent to it at a time, on average; pivots of one length of vectors at most.
BLOCK, QUERIES, PIVOTS = 8000, 4000, 2048


def lines(dim: int):
    """Random lines, a column each."""
    import numpy as np

    return np.random.default_rng([SEED, dim]).standard_normal((dim, PROJECTIONS))


def least() -> int:
    return -int(-THRESHOLD * PROJECTIONS // 1)


def leading(at, scores, k: int):
    """Those of ``at`` whose score may be among the k best, the best first."""
    import numpy as np

    order = np.argsort(-scores, kind="stable")
    if len(order) > k:
        order = order[scores[order] >= scores[order[k - 1]] - SLACK]
    return at[order], scores[order]


def two_sum(a, b, a_low=0.0, b_low=0.0):
    """a + b as a double and what rounding it left out; so are the summands."""
    s = a + b
    t = s - a
    low = (a - (s - t)) + (b - t) + a_low + b_low
    high = s + low
    return high, low - (high - s)


def two_product(a, b):
    """a * b as a double and what rounding it left out."""
    p = a * b
    split = lambda x: (x * 134217729.0) - (x * 134217729.0 - x)  # noqa: E731  the upper half of its bits
    ah, bh = split(a), split(b)
    return p, ((ah * bh - p) + ah * (b - bh) + (a - ah) * bh) + (a - ah) * (b - bh)


def inner(a, b):
    """Inner products of the rows of ``a`` with those of ``b`` in turn, in twice the double precision."""
    import numpy as np

    high, low = two_product(a, b)
    while high.shape[1] > 1:
        if high.shape[1] % 2:
            high, low = (np.pad(x, ((0, 0), (0, 1))) for x in (high, low))
        high, low = two_sum(high[:, ::2], high[:, 1::2], low[:, ::2], low[:, 1::2])
    return high[:, 0], low[:, 0]


def cosines(a, b):
    """Cosines of the rows of ``a`` with those of ``b`` in turn: the double nearest to the true value, so equal for equal angles."""
    import numpy as np

    dot, dot_low = inner(a, b)
    (aa, aa_low), (bb, bb_low) = inner(a, a), inner(b, b)
    n, n_low = two_product(aa, bb)
    n_low = n_low + aa * bb_low + aa_low * bb
    root = np.sqrt(n)
    square, square_low = two_product(root, root)
    root_low = ((n - square) - square_low + n_low) / (2 * root)
    quotient = dot / root
    back, back_low = two_product(quotient, root)
    return np.clip(quotient + (((dot - back) - back_low + dot_low) - quotient * root_low) / root, -1.0, 1.0)


def search_block(ids, vectors, queries, bounds, k: int):
    """(query, vector, cosine) of up to k candidates a query, nearest first and ties to the smaller id, and how many were verified; queries and vectors by their places.

    ``bounds`` are distances between unit vectors beyond which nothing is wanted.  A window is a range of
    places in a line's sorted array, and a vector collides where its place is in it.
    """
    import numpy as np

    given, asked = vectors, queries
    vectors, queries = (x / np.linalg.norm(x, axis=1)[:, None] for x in (given, asked))
    n, a = len(ids), lines(vectors.shape[1])
    value, centre = (vectors @ a).T, (queries @ a).T
    order = np.argsort(value, axis=1, kind="stable")
    place = np.empty((PROJECTIONS, n), np.uint16 if n <= 0xFFFF else np.uint32)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n, dtype=place.dtype), place.shape), axis=1)
    value = np.take_along_axis(value, order, axis=1)
    few = min(n, FIRST)
    near = queries @ vectors[:few].T
    start = np.full(len(queries), np.inf)
    if few >= k:  # the distance of the k-th best of the first few
        start = np.sqrt(np.maximum(0.0, 2 - 2 * np.sort(near, axis=1)[:, -k]))
    start = np.minimum(start, bounds)
    reach = np.where(np.isfinite(start), start, 8.0 * np.abs(a).sum())[:, None] * np.array(RADII)  # beyond all lines where none is known
    low = np.stack([np.searchsorted(value[j], centre[j, :, None] - reach) for j in range(PROJECTIONS)], axis=2).astype(place.dtype)
    high = np.stack([np.searchsorted(value[j], centre[j, :, None] + reach, "right") for j in range(PROJECTIONS)], axis=2).astype(place.dtype)
    pairs, verified = [], 0
    for i in range(len(queries)):
        seen = np.zeros(n, bool)
        seen[:few] = True
        found, scores = leading(np.arange(few), near[i], k)
        verified += few
        for r in range(len(RADII)):
            width = high[i, r] - low[i, r]
            hits = np.zeros(n, np.uint16)
            for at in range(0, PROJECTIONS, 32):  # so many lines at a time stay in the processor's cache
                step = slice(at, at + 32)
                hits += (place[step] - low[i, r, step, None] < width[step, None]).sum(axis=0, dtype=np.uint16)
            new = np.flatnonzero((hits >= least()) & ~seen)
            if len(new):
                seen[new] = True
                verified += len(new)
                found, scores = leading(np.concatenate([found, new]), np.concatenate([scores, vectors[new] @ queries[i]]), k)
            known = np.sqrt(max(0.0, 2 - 2 * scores[min(k, len(scores)) - 1])) if len(scores) >= min(k, n) else np.inf
            if reach[i, r] >= min(known, bounds[i]):
                break
        pairs.append(np.stack([np.full(len(found), i), found]))
    i, j = np.concatenate(pairs, axis=1) if pairs else np.empty((2, 0), int)
    exact = np.concatenate([np.empty(0), *(cosines(asked[i[at : at + 4096]], given[j[at : at + 4096]]) for at in range(0, len(i), 4096))])
    order = np.lexsort((ids[j], -exact, i))
    i, j, exact = i[order], j[order], exact[order]
    first = np.arange(len(i)) - np.searchsorted(i, i) < k
    return list(zip(i[first].tolist(), j[first].tolist(), exact[first].tolist())), verified


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null, not empty, not all zero, and has no null, NaN or infinite component."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0)).where(fine & F.exists(v, lambda x: x != 0))


def directed(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v, direction, dim) of usable rows, each once.

    A vector is scaled by a power of two, which changes no bit of its components, so that none overflows
    or vanishes.  The direction is a hash of the components over the largest: quotients are rounded to the
    nearest double, so they are equal for vectors that are multiples of one another.
    """

    def scale(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            v = batch.column("v")
            dims = v.value_lengths().to_numpy(zero_copy_only=False)
            flat, at = v.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims) - dims
            largest = np.maximum.reduceat(np.abs(flat), at)
            ratios = flat / np.repeat(largest, dims) + 0.0  # one zero, not two
            names = [hashlib.sha256(ratios[a : a + d].tobytes()).digest() for a, d in zip(at, dims)]
            flat = np.ldexp(flat, -np.repeat(np.frexp(largest)[1], dims))
            values = pa.ListArray.from_arrays(pa.array(np.concatenate([at, [len(flat)]]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("id"), values, pa.array(names, pa.binary()), pa.array(dims, pa.int32())], ["id", "v", "direction", "dim"])

    rows = usable(rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")), "v").where("id is not null")
    return rows.mapInArrow(scale, "id long, v array<double>, direction binary, dim int").dropDuplicates(["id", "direction"])


def in_cells(rows: DataFrame, pivots) -> DataFrame:
    """``rows`` with ``cell``, the nearest pivot of their length (0 where there is one or none)."""

    def assign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = {dim: np.array(v) for dim, v in pivots.value.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            flat, ends = batch.column("v").flatten().to_numpy(zero_copy_only=False), np.cumsum(dims)
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                if dim in table:
                    at = np.flatnonzero(dims == dim)
                    v = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                    cell[at] = (v @ table[dim].T).argmax(axis=1)  # the nearest, however long the vector is
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["direction", "id", "v", "dim", "cell"])

    return rows.select("direction", "id", "v", "dim").mapInArrow(assign, "direction binary, id long, v array<double>, dim int, cell int")


_FOUND = "query binary, direction binary, id long, score double, dim int, cell int, low array<double>, high array<double>, verified long"


def search(vectors: DataFrame, asked: DataFrame, k: int, ranges: bool) -> DataFrame:
    """What the queries ``asked`` (with dim, cell, bound) find in the blocks of their cells, and with ``ranges`` each block's range of projections."""
    sizes = vectors.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("subs"))  # a row a cell
    chunks = asked.groupBy("dim", "cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks"))
    spread = lambda n, salt: F.pmod(F.xxhash64("direction", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    plan = F.broadcast(sizes.join(chunks, ["dim", "cell"], "left" if ranges else "inner").withColumn("chunks", F.coalesce("chunks", F.lit(1))))
    left = vectors.join(plan, ["dim", "cell"]).select("dim", "cell", spread("subs", 1).alias("sub"), every("chunks").alias("chunk"), "direction", "id", "v")
    right = asked.join(plan, ["dim", "cell"]).select("dim", "cell", every("subs").alias("sub"), spread("chunks", 2).alias("chunk"), "direction", "v", "bound")

    def run(key, block, queries):
        import numpy as np
        import pandas as pd

        dim, cell, _, chunk = (int(x) for x in key)
        rows, v, verified = [], None, 0
        if len(block):
            block = block.sort_values(["id", "direction"])
            v = np.stack(block["v"].to_list())
        if len(block) and len(queries):
            ids, names, asked = block["id"].to_numpy(), block["direction"].to_numpy(), queries["direction"].to_numpy()
            rows, verified = search_block(ids, v, np.stack(queries["v"].to_list()), queries["bound"].to_numpy(), k)
            rows = [(asked[i], names[j], int(ids[j]), score) for i, j, score in rows]
        out = [(*r, dim, cell, None, None, None) for r in rows]
        if len(block) and (chunk == 0 and ranges or verified):
            place = v / np.linalg.norm(v, axis=1)[:, None] @ lines(dim)
            out.append((None, None, None, None, dim, cell, place.min(axis=0), place.max(axis=0), verified))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _FOUND.split(", ")]).astype({"id": "Int64", "score": "Float64", "verified": "Int64"})

    keys = ("dim", "cell", "sub", "chunk")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, _FOUND)


def routed(asked: DataFrame, ranges) -> DataFrame:
    """A row for each query and each cell but its own whose range its windows meet on enough lines."""

    def route(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = ranges.value
        for batch in batches:
            rows = []
            for at, (v, dim, home, bound) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("v", "dim", "cell", "bound")))):
                cells, low, high = table[dim]
                centre = np.array(v) / np.linalg.norm(v) @ lines(dim)
                met = ((low <= centre + bound) & (high >= centre - bound)).sum(axis=1) >= least()
                rows += [(at, int(c)) for c in cells[met & (cells != home)]]
            taken = batch.take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in ("direction", "v", "dim", "bound")), pa.array([r[1] for r in rows], pa.int32())], ["direction", "v", "dim", "bound", "cell"])

    return asked.select("direction", "v", "dim", "cell", "bound").mapInArrow(route, "direction binary, v array<double>, dim int, bound double, cell int")


def top(found: DataFrame, k: int, query: str, what: str) -> DataFrame:
    """The k best ``what`` of each ``query``, by score and then by id."""
    best = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), *dict.fromkeys(("id", what))))
    once = found.where(F.col(query).isNotNull()).groupBy(query, *dict.fromkeys((what, "id"))).agg(F.max("score").alias("score"))
    return once.withColumn("rank", best).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, *, queries: DataFrame | None = None, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, id, score): for each query the k nearest ids found by cosine, nearest first, ties to the smaller id.

    ``queries`` are rows of the same columns; by default those of ``vectors`` whose id is divisible by
    ``every``.  A row is known by its id: rows of the query's id are the query's own and are passed over,
    whatever their vectors.  Vectors that are null, empty or zero, or hold a null or non-finite component,
    take no part, nor do null ids; ids that are no whole numbers fail the cast.  Vectors of other lengths
    than the query's are never compared.  Repeated rows of one id and vector count once; an id with two
    vectors is searched with both and found by the better of them.  Columns other than these two play no
    part.  With no more than k candidates all are returned; empty tables give no rows.
    """
    return search_all(vectors, queries, id_col, vector, k, every)[0]


def search_all(vectors: DataFrame, queries: DataFrame | None, id_col: str, vector: str, k: int, every: int) -> tuple[DataFrame, DataFrame]:
    """``nearest``, and all that both searches emitted (a block's own row has how many vectors it verified)."""
    import numpy as np

    spark = vectors.sparkSession
    rows = settled(directed(vectors, id_col, vector), "ann-rows")
    place = F.row_number().over(Window.partitionBy("direction").orderBy("id"))
    members = settled(rows.withColumn("place", place).where(F.col("place") <= k + 1), "ann-vectors")
    base = members.where("place = 1")
    wanted = rows.where(F.pmod("id", F.lit(every)) == 0) if queries is None else settled(directed(queries, id_col, vector), "ann-wanted")
    asked = wanted.groupBy("direction", "dim").agg(F.min_by("v", "id").alias("v"), F.min("id").alias("id"))
    find = k + 1  # the query's own direction is among them
    pivots = {}
    for r in base.groupBy("dim").count().collect():  # a row a length of vectors
        if r["count"] > BLOCK:
            taken = base.where(F.col("dim") == r.dim).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(min(PIVOTS, -(-r["count"] // BLOCK)))
            pivots[r.dim] = [(np.array(x.v) / np.linalg.norm(x.v)).tolist() for x in taken.select("v").collect()]  # at most PIVOTS rows
    shared = spark.sparkContext.broadcast(pivots)
    cells = settled(in_cells(base, shared), "ann-cells")
    asked = settled(in_cells(asked, shared).withColumn("bound", F.lit(float("inf"))), "ann-queries")
    first = settled(search(cells, asked, find, ranges=True), "ann-first")

    def span(pdf):
        return pdf.iloc[:1].assign(low=[np.min(np.stack(pdf["low"].to_list()), axis=0)], high=[np.max(np.stack(pdf["high"].to_list()), axis=0)])

    spans = first.where("query is null").select("dim", "cell", "low", "high").groupBy("dim", "cell").applyInPandas(span, "dim int, cell int, low array<double>, high array<double>").collect()  # a row a cell
    table = {dim: tuple(np.array([s[c] for s in spans if s.dim == dim]) for c in ("cell", "low", "high")) for dim in {s.dim for s in spans}}
    known = top(first, find, "query", "direction").groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
    bound = F.when(F.col("n") >= find, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("worst")))).otherwise(F.lit(float("inf")))
    bounded = asked.drop("bound").join(known, F.col("direction") == F.col("query"), "left").withColumn("bound", F.coalesce(bound, F.lit(float("inf"))))
    bounded = bounded.join(F.broadcast(spark.createDataFrame([(d,) for d in table], "d int")), F.col("dim") == F.col("d"), "left_semi")
    second = settled(search(cells, settled(routed(bounded, spark.sparkContext.broadcast(table)), "ann-routed"), find, ranges=False), "ann-second")
    found = first.unionByName(second)
    # each direction found stands for its ids, each direction asked for its queries
    best = top(found, find, "query", "direction").select("query", F.col("direction").alias("of"), "score")
    asking = wanted.select(F.col("id").alias("query_id"), F.col("direction").alias("query"))
    each = asking.join(best, "query").join(members.select(F.col("direction").alias("of"), "id"), "of").where("query_id <> id")
    return top(each.select("query_id", "id", "score"), k, "query_id", "id").select("query_id", "rank", "id", "score"), found
