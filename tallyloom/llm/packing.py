"""Best-fit packing of token pieces into sequences, by a configuration linear program.

1. Texts are encoded once into pieces of at most ``capacity`` tokens: (length, checksum) rows.
2. The histogram of lengths, ``capacity`` numbers however large the corpus, goes to the driver.
   There the fractional cover by configurations (multisets of sizes that fit a sequence) is found by
   multiplicative weights: each round a knapsack dynamic program prices the configuration worth most
   under the current weights of the sizes, the round uses it, and the weights of what it covered
   shrink in proportion.  A size stands for the lengths of one ``GRAIN``-th of a sequence and is as
   long as the longest of them, so a length that is alone there is priced as it is.  Uses are
   rounded down to whole sequences, and each sequence takes real lengths of its sizes, the last two
   so that they fill it.  What no use filled is solved again, in ``PASSES``; what is left after those
   is packed best-fit decreasing, into new sequences and the gaps left in the others.
3. The plan says for each length which ranks go to which run of sequences.  Pieces are ranked within
   their length by two-level counts (blocks of bounded size, then offsets), so that no task holds one
   length, and each task looks its ranks up in the plan.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled
from tallyloom.llm.tokens import encoder

CAPACITY = 4096
#: Rounds of multiplicative weights a pass at most, how strongly being covered lessens a size's worth, and the power of its share of a sequence that it is worth at first (above 1, so that long pieces, which are harder to place, are not left to the end).
ROUNDS, RATE, WORTH = 4000, 2.0, 1.5
#: Parts of a sequence whose lengths are one size of the program.
GRAIN = 256
#: Passes of the program: how far a round takes a size, and whether a sequence may stay as empty as its configuration is, or must be full.
PASSES = ((0.2, False), (0.5, False), (0.5, True))
#: Pieces in a ranking block, on average.
BLOCK = 20_000


def best_configuration(lengths, worth, most, capacity: int) -> dict[int, int]:
    """{size: pieces} of total length at most ``capacity`` that is worth most, by dynamic programming.

    ``lengths[s]`` and ``worth[s]`` are those of one piece of size s, ``most[s]`` how many there are.
    Copies of a size are tried in bundles of 1, 2, 4, ..., which add up to every number of them.
    """
    import numpy as np

    value, taken = np.zeros(capacity + 1), []
    for s in np.flatnonzero(most):
        length, left, bundle = int(lengths[s]), min(int(most[s]), capacity // int(lengths[s])), 1
        while left:
            bundle = min(bundle, left)
            with_it = value[: capacity + 1 - bundle * length] + bundle * worth[s]
            better = with_it > value[bundle * length :]
            np.maximum(value[bundle * length :], with_it, out=value[bundle * length :])
            taken.append((int(s), bundle, bundle * length, better))
            left, bundle = left - bundle, bundle * 2
    out: dict[int, int] = {}
    c = capacity
    for s, bundle, length, better in reversed(taken):
        if c >= length and better[c - length]:
            out[s] = out.get(s, 0) + bundle
            c -= length
    return out


def fractional_cover(need, lengths, capacity: int, stride: float, rounds: int) -> list[tuple[float, dict[int, int]]]:
    """(uses, configuration) that together cover ``need`` pieces of each size, few uses in sum.

    Multiplicative weights: a size is worth a power of its share of a sequence, less by a factor that
    grows with how far it is covered.  Each round uses the best configuration until the scarcest of its sizes is
    ``stride`` further, or once if that is more; a size that is covered drops out.
    """
    import numpy as np

    got, found = np.zeros(len(need)), {}
    for _ in range(rounds):
        left = np.ceil(np.maximum(need - got - 1e-9, 0)).astype(np.int64)
        if not left.any():
            break
        config = best_configuration(lengths, (lengths / capacity) ** WORTH * np.exp(-RATE * got / np.maximum(need, 1)), left, capacity)
        step = min(min((need[s] - got[s]) / n for s, n in config.items()), max(1.0, min(stride * need[s] / n for s, n in config.items())))
        key = tuple(sorted(config.items()))
        found[key] = found.get(key, 0.0) + step
        for s, n in config.items():
            got[s] += step * n
    return [(amount, dict(key)) for key, amount in found.items()]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, {length: pieces in each}) that together hold the histogram exactly.

    Work and result depend on ``capacity`` and ``rounds``, not on how many pieces there are.
    """
    left, groups = program(histogram, capacity, rounds)
    return best_fit(left, groups, capacity)


def program(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS):
    """(pieces left of each length, sequences that the program fills)."""
    import numpy as np

    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1 to {capacity}")
        left[length] = n
    groups: list[tuple[int, dict[int, int]]] = []
    unit = -(-capacity // GRAIN)
    sizes = -(-np.arange(capacity + 1) // unit)
    for stride, as_planned in PASSES:
        need, longest = np.bincount(sizes, left).astype(np.int64), np.zeros(sizes[-1] + 1, dtype=np.int64)
        np.maximum.at(longest, sizes, np.where(left > 0, np.arange(capacity + 1), 0))
        cover = fractional_cover(need, longest, capacity, stride, rounds)
        for amount, config in sorted(cover, key=lambda x: (-x[0], sorted(x[1].items()))):
            planned = capacity - sum(int(longest[s]) * n for s, n in config.items())
            groups += filled(int(amount + 1e-6), config, left, unit, capacity, planned if as_planned else 0)
    return left, groups


def filled(n: int, config: dict[int, int], left, unit: int, capacity: int, slack: int) -> list[tuple[int, dict[int, int]]]:
    """Up to ``n`` sequences of a configuration as runs of real lengths, taken out of ``left``.

    All pieces but two are of the commonest length of their size; then comes a length of the next
    size and the longest that fits beside it, those that leave least room.  It ends where a size has no
    piece, or more than ``slack`` would stay empty.
    """
    import numpy as np

    slots_ = sorted((s for s, k in config.items() for _ in range(k)), reverse=True)
    out: list[tuple[int, dict[int, int]]] = []
    lengths_of = lambda s, most: slice((s - 1) * unit + 1, min(s * unit, most) + 1)
    while n > 0:
        free, used, room = left.copy(), {}, capacity
        for s in slots_[:-2]:
            length = lengths_of(s, capacity).start + int(free[lengths_of(s, capacity)].argmax())
            if free[length] < 1:
                return out
            free[length] -= 1
            used[length] = used.get(length, 0) + 1
            room -= length
        window = lengths_of(slots_[-2:][0], room)
        first = window.start + np.flatnonzero(free[window] > 0)
        if not len(first):
            return out
        second = np.zeros_like(first)
        if len(slots_) > 1:
            longest = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))  # the longest piece up to a length
            second = longest[room - first]
            second = np.where((second == first) & (free[first] < 2), longest[np.minimum(first - 1, room - first)], second)
        runs = np.where(second == first, free[first] // 2, np.minimum(free[first], np.where(second > 0, free[second], free[first])))
        at = np.lexsort((-runs, room - first - second))[0]
        for length in (int(first[at]), int(second[at])):
            if length:
                used[length] = used.get(length, 0) + 1
                room -= length
        if room > slack:
            return out
        run = min(n, min(int(left[length]) // k for length, k in used.items()))
        for length, k in used.items():
            left[length] -= run * k
        out.append((run, used))
        n -= run
    return out


def best_fit(left, groups: list[tuple[int, dict[int, int]]], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Adds the pieces of ``left`` to ``groups``, longest first, each where it leaves the smallest gap; runs of equal sequences move together."""
    open_at: dict[int, list[tuple[int, dict[int, int]]]] = {}
    gaps: list[int] = []

    def put(n: int, config: dict[int, int]) -> None:
        gap = capacity - sum(length * k for length, k in config.items())
        if gap not in open_at:
            open_at[gap] = []
            insort(gaps, gap)
        open_at[gap].append((n, config))

    for n, config in groups:
        put(n, config)
    for length in range(capacity, 0, -1):
        todo = int(left[length])
        while todo:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fits = capacity // length
                if todo >= fits:
                    put(todo // fits, {length: fits})
                    todo %= fits
                else:
                    put(1, {length: todo})
                    todo = 0
                continue
            gap = gaps[at]
            n, config = open_at[gap].pop()
            if not open_at[gap]:
                del open_at[gap], gaps[at]
            moved = min(n, todo)
            put(moved, config | {length: config.get(length, 0) + 1})
            if n > moved:
                put(n - moved, config)
            todo -= moved
    return [group for gap in gaps for group in open_at[gap]]


def slots(groups: list[tuple[int, dict[int, int]]]):
    """The plan as arrays sorted by (length, first rank): length, first rank, first sequence, pieces a sequence, offset."""
    import numpy as np

    rows, used, sequence = [], {}, 0
    for n, config in groups:
        offset = 0
        for length, k in sorted(config.items(), reverse=True):
            rows.append((length, used.get(length, 0), sequence, k, offset))
            used[length] = used.get(length, 0) + n * k
            offset += length * k
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text: str = "text", end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(id, row, piece, start, length, ids_crc32): each whole text's ids and the end id, cut only where longer than ``capacity``.

    A null or empty text is one piece, the end id.  ``row`` tells rows that share an id apart.
    """

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        coder, end = encoder(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            out = []
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for doc, row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), coder.ids(texts)):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    out.append((doc, row, k, at // 4, len(part) // 4, zlib.crc32(part)))
            for k in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[k : k + 20_000]), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))], ["id", "row", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(cut, "id long, row long, piece int, start long, length int, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", capacity: int = CAPACITY, rounds: int = ROUNDS, **options) -> DataFrame:
    """Every piece's place: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences are gapless from offset 0 and hold at most ``capacity`` tokens.  Rows that share an id,
    or are equal, are packed apart.  A null or empty text is one piece of the end id, a text of any
    length is cut whole.  Ids that are no whole numbers fail the cast.  An empty table gives no rows;
    columns other than the id and the text play no part.
    """
    spark = docs.sparkSession
    cut = settled(pieces(docs, tokenizer, id_col=id_col, capacity=capacity, **options), "pieces")
    counts = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(slots(plan_sequences(counts, capacity, rounds)))  # bounded by ``capacity`` and ``rounds``
    blocks = max(1, sum(counts.values()) // BLOCK)
    block = F.pmod(F.xxhash64("id", "row", "piece"), F.lit(blocks))
    placed = cut.withColumn("block", block)
    in_block = Window.partitionBy("length", "block").orderBy("id", "row", "piece")
    offsets = placed.groupBy("length", "block").count().withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    ranked = placed.withColumn("k", F.row_number().over(in_block) - 1).join(offsets, ["length", "block"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("k")).alias("rank"))

    def place(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = plan.value
        span = 1 << 40
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = table[np.searchsorted(keys, length * span + rank, "right") - 1]
            inside = rank - at[:, 1]
            sequence, offset = at[:, 2] + inside // at[:, 3], at[:, 4] + inside % at[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "piece", "start")), pa.array(length), batch.column("ids_crc32"), pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("id", id_col)
