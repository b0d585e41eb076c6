"""A content-addressed store of token ids.

Each document's ids (its tokens and the end id) are cut into chunks where a rolling hash over the
last 16 ids says so, so equal passages give equal chunks wherever they stand.  A chunk's name is the
SHA-256 of its bytes.  The store at ``path`` holds three Parquet tables:

``chunks``    a row for each use of a chunk; its bytes (ids, little-endian, 16 bits where the
              vocabulary allows, else 32) stand in exactly one row of each name
``recipes``   in ascending document id: the names of a document's chunks, their numbers of ids, the
              Merkle root over the names, and where the document starts in its part (``kind`` is
              ``document``); and a sum of each part (``kind`` is ``part``)
``manifest``  a row for each part of the recipes: documents, ids, ids before it, and the Merkle root
              over its documents' roots

A text is encoded once.  Only the first use of a chunk in a task ships its bytes, keyed by name;
other uses travel without bytes under a key of their own, so a chunk that a third of all documents
share fills no task.  The number of parts follows the number of documents.  Writing computes a
part's root document by document, in memory of its logarithm; verifying computes it again as a tree
of blocks of ``LEAVES`` documents.  Reading verifies names against bytes and roots against names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled
from tallyloom.llm.tokens import encoder

SPAN, MIN_IDS, MAX_IDS, CUT_BITS = 16, 128, 4096, 10
#: Documents in a part on average, and in a block of a part when its root is verified (a power of two, so that the tree is the same).
PART, LEAVES = 200_000, 4096


def cuts(ids) -> list[int]:
    """Ends of the chunks of an id array: 2**CUT_BITS ids apart on average, between MIN_IDS and MAX_IDS."""
    import numpy as np

    n = len(ids)
    if n <= MIN_IDS:
        return [n]
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    shift = 1
    while shift < SPAN:  # h[i] becomes the sum of the last SPAN mixed ids, each shifted by its distance
        h[shift:] += h[:-shift] << np.uint64(shift)
        shift *= 2
    marks = np.flatnonzero(h >> np.uint64(64 - CUT_BITS) == 0) + 1
    out, at = [], 0
    for mark in [*marks.tolist(), n]:
        while mark - at > MAX_IDS:
            at += MAX_IDS
            out.append(at)
        if mark - at >= MIN_IDS or mark == n and mark > at:
            at = mark
            out.append(at)
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary tree over ``leaves``; an odd one out moves up."""
    return merkle_up([hashlib.sha256(b"\0" + x).digest() for x in leaves])


def merkle_up(level: list[bytes]) -> bytes:
    """Root over nodes that stand at one height of the tree."""
    level = level or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


class Tree:
    """``merkle`` over leaves that come one by one: of the tree so far only the roots of its whole halves are held."""

    def __init__(self):
        self.whole: list[tuple[int, bytes]] = []

    def add(self, leaf: bytes) -> None:
        height, node = 0, hashlib.sha256(b"\0" + leaf).digest()
        while self.whole and self.whole[-1][0] == height:
            node, height = hashlib.sha256(b"\1" + self.whole.pop()[1] + node).digest(), height + 1
        self.whole.append((height, node))

    def root(self) -> bytes:
        nodes = [node for _, node in self.whole] or [hashlib.sha256(b"").digest()]
        root = nodes.pop()
        while nodes:
            root = hashlib.sha256(b"\1" + nodes.pop() + root).digest()
        return root


def crc32_join(a, b, b_bytes):
    """crc32 of x + y from crc32(x), crc32(y) and the length of y, over arrays.

    Appending a zero bit is linear over the bits of a crc; the squares of that 32x32 bit matrix take
    it 8, 16, 32, ... bits further, and the length's binary digits choose among them.
    """
    import numpy as np

    matrix = np.array([0xEDB88320] + [1 << i for i in range(31)], dtype=np.uint32)

    def times(m, v):
        out = np.zeros_like(v)
        for i in range(32):
            out ^= np.where(v >> np.uint32(i) & np.uint32(1), m[i], np.uint32(0))
        return out

    for _ in range(3):
        matrix = times(matrix, matrix)
    a, left = a.astype(np.uint32), b_bytes.astype(np.int64)
    while left.any():
        a = np.where(left & 1, times(matrix, a), a)
        matrix, left = times(matrix, matrix), left >> 1
    return a ^ b.astype(np.uint32)


def write_store(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text: str = "text", end_id: int = 2, wide: bool = False, parts: int | None = None) -> None:
    """Encodes every whole text and writes the store to ``path``, a folder that all executors see.

    Null and empty texts hold the end id alone.  Rows that share an id are documents of their own,
    next to each other.  Ids that are no whole numbers fail the cast.  An empty table gives empty
    tables.  ``wide`` stores 32-bit ids; without it an id of 65,536 or more raises ValueError.  A text
    of any length is encoded whole and becomes chunks of bounded size.
    """
    spark = docs.sparkSession

    def chunked(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        coder, seen = encoder(tokenizer), set()
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows: list[tuple] = []
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for doc, row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), coder.ids(texts)):
                ids, at = np.concatenate([np.frombuffer(raw, "<u4"), end]), 0
                if not wide and ids.max() > 0xFFFF:
                    raise ValueError(f"id {ids.max()} needs a wide store")
                for seq, upto in enumerate(cuts(ids)):
                    blob = ids[at:upto].astype("<u4" if wide else "<u2").tobytes()
                    name = hashlib.sha256(blob).digest()
                    new = name not in seen
                    if new:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(name)
                    rows.append((doc, row, seq, name, upto - at, blob if new else None))
                    at = upto
            for k in range(0, len(rows), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[k : k + 5000]), (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary()))], ["doc", "row", "seq", "name", "n", "blob"])

    uses = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text")).mapInArrow(chunked, "doc long, row long, seq int, name binary, n int, blob binary")
    key = F.when(F.col("blob").isNotNull(), F.xxhash64("name")).otherwise(F.xxhash64("row", "seq"))
    first = F.row_number().over(Window.partitionBy("key", "name", F.col("blob").isNull()).orderBy("row", "seq"))
    once = uses.withColumn("key", key).withColumn("first", first).withColumn("blob", F.when(F.col("first") == 1, F.col("blob"))).drop("key", "first")
    once.write.option("compression", "zstd").parquet(f"{path}/chunks")

    recipes = settled(
        spark.read.parquet(f"{path}/chunks").select("doc", "row", "seq", "name", "n").groupBy("doc", "row")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "name", "n"))).alias("c"))
        .select("doc", "row", F.col("c.name").alias("names"), F.col("c.n").alias("counts"))
        .withColumn("n_ids", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)),
        "store-recipes",
    )
    order = [F.col("doc").asc_nulls_first(), F.col("n_ids"), F.xxhash64("names"), F.col("row")]
    parts = parts or max(1, -(-recipes.count() // PART))
    in_order = recipes.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = "doc long, names array<binary>, counts array<int>, n_ids long, part int, root binary, place long, part_start long, kind string"

    def placed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        place, start, part, tree = 0, 0, None, Tree()
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            n = batch.column("n_ids").to_numpy(zero_copy_only=False)
            if not len(n):
                continue
            ends, part = start + np.cumsum(n), batch.column("part")[0].as_py()
            flat, at = batch.column("names").flatten().to_pylist(), np.cumsum([0, *batch.column("names").value_lengths().to_pylist()]).tolist()
            roots = [merkle(flat[a:b]) for a, b in zip(at, at[1:])]
            for root in roots:
                tree.add(root)
            extra = [pa.array(roots, pa.binary()), pa.array(place + np.arange(len(n), dtype=np.int64)), pa.array((ends - n).astype(np.int64)), pa.array(["document"] * len(n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)
            place, start = place + len(n), int(ends[-1])
        if part is not None:
            row = [(None, pa.int64()), (None, pa.list_(pa.binary())), (None, pa.list_(pa.int32())), (start, pa.int64()), (part, pa.int32()), (tree.root(), pa.binary()), (place, pa.int64()), (None, pa.int64()), ("part", pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in row], names)

    in_order.select("doc", "names", "counts", "n_ids", "part").mapInArrow(placed, schema).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/recipes")
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a part
    sums = recipes_of(spark, path, "part").select("part", F.col("place").alias("n_docs"), "n_ids", "root")
    sums.withColumn("ids_before", before).write.parquet(f"{path}/manifest")


def recipes_of(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = "doc long, names array<binary>, counts array<int>, n_ids long, part int, root binary, place long, part_start long, kind string"
    return spark.read.schema(schema).parquet(f"{path}/recipes").where(F.col("kind") == kind).drop("kind")


def per_part(spark: SparkSession, path: str) -> DataFrame:
    """(part, n_docs, n_ids, root) from the documents' recipes: what the manifest must say."""

    def rooted(up):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                nodes = [up([x["root"] for x in c]) for c in batch.column("c").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("part", "block", "n_docs", "n_ids")), pa.array(nodes, pa.binary())], ["part", "block", "n_docs", "n_ids", "root"])

        return run

    schema, nodes = "part int, block long, n_docs long, n_ids long, root binary", F.sort_array(F.collect_list(F.struct("at", "root"))).alias("c")
    blocks = recipes_of(spark, path, "document").select("part", F.floor(F.col("place") / LEAVES).alias("block"), F.col("place").alias("at"), "root", "n_ids")
    blocks = blocks.groupBy("part", "block").agg(F.count("*").alias("n_docs"), F.sum("n_ids").alias("n_ids"), nodes).mapInArrow(rooted(merkle), schema)
    tops = blocks.withColumn("at", F.col("block")).groupBy("part").agg(F.min("block").alias("block"), F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids"), nodes)
    return tops.select("part", "block", "n_docs", "n_ids", "c").mapInArrow(rooted(merkle_up), schema).drop("block")


def verify(spark: SparkSession, path: str) -> None:
    """Raises ValueError if a part's recipes do not give the root, documents and ids of its manifest row."""
    want, have = spark.read.parquet(f"{path}/manifest").drop("ids_before"), per_part(spark, path)
    wrong = want.join(have.select(*[F.col(c).alias(f"h_{c}") for c in have.columns]), F.col("part") == F.col("h_part"), "full")
    same = F.col("root").eqNullSafe(F.col("h_root")) & F.col("n_docs").eqNullSafe(F.col("h_n_docs")) & F.col("n_ids").eqNullSafe(F.col("h_n_ids"))
    if bad := wrong.where(~same).select(F.coalesce("part", "h_part")).take(5):
        raise ValueError(f"parts {[r[0] for r in bad]} do not match their manifest")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc, start, n_ids, ids_crc32) of every document, from the files.

    Every chunk's bytes are hashed again and must give its name, and the names of every recipe its
    root, else the job fails.  A document's crc is joined from its chunks' crcs, so the bytes of a
    chunk are read once however many documents use it, and are never shuffled.
    """

    def read(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            crcs = []
            for name, n, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if hashlib.sha256(blob).digest() != name or len(blob) not in (2 * n, 4 * n):
                    raise ValueError(f"chunk {name.hex()} does not match its bytes")
                crcs.append(zlib.crc32(np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crcs, pa.int64())], ["name", "crc"])

    def rebuilt(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            c = batch.column("c")
            lengths = c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at, flat = np.cumsum(lengths) - lengths, c.flatten()
            names, crcs, n = flat.field("name").to_pylist(), flat.field("crc"), flat.field("n").to_numpy(zero_copy_only=False)
            if crcs.null_count or any(merkle(names[a : a + m]) != root for a, m, root in zip(at.tolist(), lengths.tolist(), batch.column("root").to_pylist())):
                raise ValueError("a recipe does not match its chunks")
            crc, crcs = np.zeros(len(lengths), np.uint32), crcs.to_numpy(zero_copy_only=False)
            for k in range(int(lengths.max(initial=0))):
                more = np.flatnonzero(lengths > k)
                crc[more] = crc32_join(crc[more], crcs[at[more] + k], 4 * n[at[more] + k].astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("part"), batch.column("part_start"), batch.column("n_ids"), pa.array(crc.astype(np.int64))], ["doc", "part", "part_start", "n_ids", "ids_crc32"])

    chunks = spark.read.parquet(f"{path}/chunks").where("blob is not null").select("name", "n", "blob").mapInArrow(read, "name binary, crc long")
    recipes = recipes_of(spark, path, "document").select("doc", "part", "place", "part_start", "n_ids", "root", F.posexplode(F.arrays_zip("names", "counts")).alias("seq", "x"))
    found = recipes.select("*", F.col("x.names").alias("name"), F.col("x.counts").alias("n")).drop("x").join(chunks, "name", "left")
    whole = found.groupBy("part", "place").agg(*[F.first(c).alias(c) for c in ("doc", "part_start", "n_ids", "root")], F.sort_array(F.collect_list(F.struct("seq", "name", "n", "crc"))).alias("c"))
    out = whole.mapInArrow(rebuilt, "doc long, part int, part_start long, n_ids long, ids_crc32 long")
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "ids_before")
    return out.join(manifest, "part").select("doc", (F.col("ids_before") + F.col("part_start")).alias("start"), "n_ids", "ids_crc32")
