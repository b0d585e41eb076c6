"""Near-duplicate groups by DartMinHash signatures, banding and exact verification.

A text's elements are its five-word shingles, each with a weight: its count (similarity is then the
weighted Jaccard of the multisets), or 1 for every distinct shingle (then Jaccard's of the sets).  Darts are thrown by hashing: each unit of an element's weight has its own Poisson
process of hashed ranks, the same in every text; of the darts that land below an element's weight
the one of lowest rank in each of ``BANDS * ROWS`` hashed coordinates is the signature.  About
``k (ln k + 2)`` darts fill k coordinates, however many elements a text has.

Texts that agree on a whole band meet in its bucket.  Groups of any size stay cheap: equal texts are
one node; a bucket links its members to its smallest member alone, and a link counts only if the
shingle sets, from the whole texts, are similar enough.  After connected components are found, members of a bucket that its star left in
different components are compared with each other, block by block, so no link that the bands show
is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN, settled

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**32, about 3 in a million.
BANDS, ROWS = 32, 5
#: Signatures that agree on fewer coordinates than this share come from similarities under 0.8, but for 1 pair in 10 million.
#: It spares the comparison of texts in buckets whose star left them apart; 0 compares them all.
LEAST_AGREEMENT = 0.63
#: Elements hashed at a time, and members of a bucket compared at a time.
STEP, BLOCK = 600_000, 256


def mix(h):
    """A bijection of 64 bits that spreads them."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def uniform(h):
    import numpy as np

    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(elements, weights, owner, n: int, k: int):
    """uint64[n, k]: DartMinHash of n weighted sets, given as parallel arrays of element, weight > 0 and set number.

    Every set must have an element.
    """
    import numpy as np

    best, rank = np.zeros(n * k, np.uint64), np.full(n * k, np.inf)
    cells = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), cells)
    unit = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    key, room, owner = mix(elements[at] ^ mix(unit.astype(np.uint64) + np.uint64(1))), weights[at] - unit, owner[at]
    below = k * (np.log(k) + 2) / np.bincount(owner, np.minimum(room, 1.0), n)
    while True:
        live, r, throw = np.arange(len(key)), np.zeros(len(key)), 0
        while len(live):
            throw += 1
            dart = mix(key[live] + np.uint64(throw * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            r = r - np.log1p(-uniform(dart))
            near = r <= below[owner[live]]
            live, r, dart = live[near], r[near], dart[near]
            spot = mix(dart ^ np.uint64(0xD6E8FEB86659FD93))
            hit = uniform(mix(spot)) < room[live]
            place = owner[live[hit]] * k + (spot[hit] % np.uint64(k)).astype(np.int64)
            np.minimum.at(rank, place, r[hit])
            first = rank[place] == r[hit]
            best[place[first]] = dart[hit][first]
        empty = np.isinf(rank).reshape(n, k).any(axis=1)
        if not empty.any():
            return best.reshape(n, k)
        again = empty[owner]
        key, room, owner = key[again], room[again], owner[again]
        below = below * 2


class WordHashes(dict):
    """word -> 64-bit hash, kept up to a bound."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return h


def shingles(text: str, hashes: WordHashes, n: int = SHINGLE):
    """Sorted distinct shingle hashes and their counts: lower-cased words between white space, ``n`` in a row.

    A text of fewer words is one shingle; a text without words has none.
    """
    import numpy as np

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.array(list(map(hashes.__getitem__, words)), np.uint64)
    width = min(n, len(h))
    s = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        s = s * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j]
    return np.unique(mix(s), return_counts=True)


def buckets(sig):
    """int64[n, BANDS]: a key for each band of the signatures."""
    import numpy as np

    h = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sig), 1))
    rows = sig.reshape(len(sig), BANDS, ROWS)
    for j in range(ROWS):
        h = mix(h * np.uint64(31) + rows[:, :, j])
    return h.view(np.int64)


def text_key(text: str = "text") -> Column:
    """16 bytes that tell texts apart; all texts without a word are one."""
    c = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return F.unhex(F.md5(F.when(F.length(F.regexp_replace(c, r"(?U)\s", "")) == 0, F.lit("")).otherwise(c)))


def row_key(id_col: str, text: str) -> Column:
    """16 bytes that tell documents apart: by id and text."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("~")), F.coalesce(F.col(f"`{text}`"), F.lit("")))))


def signed(docs: DataFrame, text: str, weighting: str) -> DataFrame:
    """(t, key, bands, sig) of each text with a word: its short and whole key, its bucket keys, and 8 bits of each coordinate before the bytes of the bucket keys."""

    def sign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            keys, texts, at = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), batch.column(2).to_pylist(), 0
            while at < len(texts):
                sets, named, size = [], [], 0
                while at < len(texts) and (not sets or size < STEP):
                    found = shingles(texts[at] or "", hashes)
                    if len(found[0]):
                        sets.append(found)
                        named.append(keys[at])
                        size += len(found[0])
                    at += 1
                if not sets:
                    continue
                elements = np.concatenate([s[0] for s in sets])
                weights = np.concatenate([s[1] for s in sets]).astype(np.float64) if weighting == "count" else np.ones(len(elements))
                sig = signatures(elements, weights, np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets]), len(sets), BANDS * ROWS)
                low, shared = (sig & np.uint64(0xFF)).astype(np.uint8), buckets(sig)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(shared.ravel()), BANDS).cast(pa.list_(pa.int64()))
                t, key = (pa.array([x[k] for x in named], kind) for k, kind in enumerate((pa.int64(), pa.binary())))
                yield pa.RecordBatch.from_arrays([t, key, bands, pa.array([x.tobytes() + k.tobytes() for x, k in zip(low, shared)], pa.binary())], ["t", "key", "bands", "sig"])

    keyed = docs.select(text_key(text).alias("key"), F.col(f"`{text}`").alias("text"))
    return keyed.select(short_key(F.col("key")), "key", "text").mapInArrow(sign, "t long, key binary, bands array<long>, sig binary")


def short_key(key: Column) -> Column:
    """The first 60 bits of a key as ``t``; candidates are looked up by it, links carry whole keys."""
    return F.conv(F.substring(F.hex(key), 1, 15), 16, 10).cast("long").alias("t")


def other_key(key: Column) -> Column:
    """The last 60 bits of a key, with a bit that no ``short_key`` has."""
    return (F.conv(F.substring(F.hex(key), 18, 15), 16, 10).cast("long") + F.lit(1 << 60)).alias("t")


def told_apart(keyed: DataFrame, shared: DataFrame | None) -> DataFrame:
    """``keyed`` (t, key, ...) with the other short key where several texts have one ``t``."""
    if shared is None:
        return keyed
    marked = keyed.join(F.broadcast(shared.select(F.col("t").alias("__t"))), F.col("t") == F.col("__t"), "left")
    return marked.withColumn("t", F.when(F.col("__t").isNull(), F.col("t")).otherwise(other_key(F.col("key")))).drop("__t")


def shared_keys(nodes: DataFrame) -> DataFrame | None:
    """The few ``t`` that several texts have, or None; expected are n * n / 2**61 of them."""
    shared = settled(nodes.groupBy("t").count().where("count > 1").select("t"), "near-shared")
    return None if shared.isEmpty() else shared


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(t, key, text) of the texts whose short key is in ``wanted``, each once."""
    rows = nodes.join(wanted.select("t").distinct(), "t").select("row", "t", "key")
    found = docs.select(row_key(id_col, text).alias("row"), F.col(f"`{text}`").alias("text")).join(rows, "row").select("row", "t", "key", "text")
    return found.withColumn("one", F.row_number().over(Window.partitionBy("row").orderBy(F.lit(1)))).where("one = 1").drop("one", "row")


def similar(a, n, b, m, similarity: float) -> bool:
    """Whether two sets of sorted elements, with counts n and m, are similar enough."""
    import numpy as np

    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both >= similarity * (int(n.sum() + m.sum()) - both)


def weighed(text: str, hashes: WordHashes, weighting: str):
    import numpy as np

    elements, counts = shingles(text, hashes)
    return elements, counts if weighting == "count" else np.ones(len(elements), np.int64)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text: str, similarity: float, weighting: str) -> DataFrame:
    """Of candidate (a, b) short keys, the links (u, v) between texts of at least ``similarity``, by whole keys, u < v."""
    texts = settled(texts_of(pairs.select(F.col("a").alias("t")).union(pairs.select(F.col("b").alias("t"))), nodes, docs, id_col, text), "near-texts")

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes, kept = WordHashes(), {}

        def elements(key, t):
            if key not in kept:
                if len(kept) > 2000:
                    kept.clear()
                kept[key] = weighed(t, hashes, weighting)
            return kept[key]

        for batch in batches:
            links = [(min(ka, kb), max(ka, kb)) for ka, ta, kb, tb in zip(*(batch.column(k).to_pylist() for k in range(4))) if similar(*elements(ka, ta), *elements(kb, tb), similarity)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["u", "v"])

    side = lambda name: texts.select(F.col("t").alias(name), F.col("key").alias(f"k{name}"), F.col("text").alias(f"text_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("ka != kb")
    return both.select("ka", "text_a", "kb", "text_b").mapInArrow(compare, "u binary, v binary")


def near_pairs(rows: list[dict], n_first: int, apart: bool, band: int, agreement: float = LEAST_AGREEMENT) -> list[tuple[int, int, int]]:
    """(-agreement, i, k) of rows of different components that their signatures do not rule out, the likeliest first.

    Rows i are the first ``n_first``; rows k come after them, or, with ``apart``, after all of them.  A
    pair that shares several buckets is found in the first of them alone, by the whole bucket keys.
    """
    import numpy as np

    raw, c, near = np.stack([np.frombuffer(r["sig"], np.uint8) for r in rows]), np.array([r["c"] for r in rows]), []
    sig, keys = np.ascontiguousarray(raw[:, : BANDS * ROWS]), np.ascontiguousarray(raw[:, BANDS * ROWS :]).view(np.int64)
    for i in range(n_first):
        begin = n_first if apart else i + 1
        equal = sig[begin:] == sig[i]
        agree = equal.sum(axis=1)
        for k in np.flatnonzero((agree >= agreement * BANDS * ROWS) & (c[begin:] != c[i])):
            if (keys[begin + k] == keys[i]).argmax() == band:
                near.append((-int(agree[k]), i, begin + int(k)))
    return sorted(near)


def block_pairs(split: DataFrame, member: list[str], name: str) -> DataFrame:
    """(bucket, band, m, m2): each pair of blocks of a bucket's members, and each block alone with a null ``m2``."""
    sizes = split.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("t"), F.col("blocks")).alias("block")
    blocks = settled(split.join(sizes, "bucket").groupBy("bucket", "band", block).agg(F.collect_list(F.struct(*member)).alias("m")), name)
    right = blocks.select(F.col("bucket").alias("b2"), F.col("block").alias("block2"), F.col("m").alias("m2"))
    pairs = blocks.join(right, (F.col("bucket") == F.col("b2")) & (F.col("block") <= F.col("block2")))
    return pairs.select("bucket", "band", "m", F.when(F.col("block") < F.col("block2"), F.col("m2")).alias("m2"))


def close_members(split: DataFrame, agreement: float) -> DataFrame:
    """(bucket, t) of members of ``split`` (t, band, bucket, c, sig) that may be similar to a member of another component."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for bucket, band, first, second in zip(*(batch.column(k).to_pylist() for k in range(4))):
                rows = first + (second or [])
                found = {i for _, a, b in near_pairs(rows, len(first), second is not None, band, agreement) for i in (a, b)}
                out += [(bucket, rows[i]["t"]) for i in sorted(found)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["bucket", "t"])

    return block_pairs(split, ["t", "c", "sig"], "near-blocks").mapInArrow(find, "bucket long, t long").distinct()


def links_across(split: DataFrame, texts: DataFrame, similarity: float, weighting: str, agreement: float) -> DataFrame:
    """(u, v): links inside buckets between texts of different components.

    ``split`` has (t, band, bucket, c, sig) of members that may be similar across components.  Each pair
    of blocks is one row, in which pairs are compared exactly, the likeliest first, and only while
    nothing yet joins their components.  So a row gives fewer links than it has members.
    """

    def elements(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            sets = [weighed(x, hashes, weighting) for x in batch.column("text").to_pylist()]
            counts = pa.array([s[1].tobytes() if weighting == "count" else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("t"), batch.column("key"), pa.array([s[0].tobytes() for s in sets], pa.binary()), counts], ["t", "key", "e", "n"])

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            links = []
            for _, band, first, second in zip(*(batch.column(k).to_pylist() for k in range(4))):
                rows, root, sets = first + (second or []), {}, {}

                def top(c, root=root):
                    while root.get(c, c) != c:
                        root[c] = root.get(root[c], root[c])
                        c = root[c]
                    return c

                def get(i, rows=rows, sets=sets):
                    if i not in sets:
                        e, n = np.frombuffer(rows[i]["e"], np.uint64), rows[i]["n"]
                        sets[i] = e, np.frombuffer(n, np.int64) if n is not None else np.ones(len(e), np.int64)
                    return sets[i]

                for _, i, k in near_pairs(rows, len(first), second is not None, band, agreement):
                    a, b = top(rows[i]["c"]), top(rows[k]["c"])
                    if a != b and similar(*get(i), *get(k), similarity):
                        root[a] = b
                        links.append((min(rows[i]["key"], rows[k]["key"]), max(rows[i]["key"], rows[k]["key"])))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["u", "v"])

    sets = texts.select("t", "key", "text").mapInArrow(elements, "t long, key binary, e binary, n binary")
    return block_pairs(split.join(sets, "t"), ["key", "c", "sig", "e", "n"], "near-close-blocks").mapInArrow(compare, "u binary, v binary")


def components(links: DataFrame) -> DataFrame:
    """(v, u): every node that is not its component's smallest, and that smallest node.

    Large-star and small-star in turn, each a group-by with map-side minimum and a join that Spark can
    split; the number of rounds grows with the logarithm of the longest path.
    """
    edges, before = settled(links.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).where("u != v").distinct(), "links"), None
    while True:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("x"), F.least("v", "m").alias("m"))
        large = settled(both.join(low, F.col("v") == F.col("x")).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(), "large-star")
        low = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("x"), "m")
        joined = large.join(low, F.col("v") == F.col("x"))
        edges = settled(joined.where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(low.select(F.col("x").alias("v"), F.col("m").alias("u"))).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def near_classes(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, weighting: str = "count", agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """(row, id, key, class_id, keeper) of every row of ``docs``.

    ``row`` and ``key`` name the row by id and text and the text alone; ``class_id`` is the smallest
    id in the row's class; ``keeper`` is the ``row`` to keep of the class.  Equal texts share a
    class, and so do all texts without a word (null, empty and blank ones), which have no shingle
    and link to nothing else.  Null ids take part and are nobody's class id unless all of a class are
    null.  Repeated rows share ``row`` and class.  Texts of any length are read whole.  Columns other
    than these two play no part.  An empty table gives no rows.
    """
    if weighting not in ("distinct", "count"):
        raise ValueError("weighting is distinct or count")
    rows = settled(docs.select(row_key(id_col, text).alias("row"), F.col(f"`{id_col}`").alias("id"), text_key(text).alias("key")), "near-rows")
    nodes = rows.groupBy("key").agg(F.min_by("row", F.struct(F.col("id").isNull(), "id", "row")).alias("row"), F.min("id").alias("id")).withColumn("t", short_key(F.col("key")))
    nodes = settled(nodes, "near-nodes")
    shared = shared_keys(nodes)
    if shared is not None:
        nodes = settled(told_apart(nodes, shared), "near-nodes")
    table = settled(told_apart(signed(docs, text, weighting), shared).drop("key"), "near-signatures")
    members = table.select("t", F.explode("bands").alias("bucket"))
    multi = members.groupBy("bucket").agg(F.min("t").alias("b"), F.max("t").alias("last")).where("b != last").select("bucket", "b")
    stars = settled(members.join(multi, "bucket").where("t != b").select(F.col("t").alias("a"), "b").distinct(), "near-stars")
    links = settled(verified(stars, nodes, docs, id_col, text, similarity, weighting), "near-links")
    labels = components(links)

    member_of = nodes.select("key", "t").join(labels.select(F.col("v").alias("key"), "u"), "key", "left").select("t", F.coalesce("u", "key").alias("u"))
    met = stars.select(F.col("a").alias("t")).union(stars.select(F.col("b").alias("t"))).distinct()
    known = table.select("t", "bands").join(met, "t").dropDuplicates(["t"]).join(member_of, "t").select("t", F.xxhash64("u").alias("c"), F.posexplode("bands").alias("band", "bucket"))
    mixed = known.groupBy("bucket").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 != c1").select("bucket")
    split = known.join(mixed, "bucket")
    sigs = table.select("t", "sig").join(met, "t").dropDuplicates(["t"])
    split = settled(split.join(sigs, "t"), "near-split")
    close = settled(split.join(close_members(split, agreement), ["bucket", "t"], "left_semi"), "near-close")
    more = settled(links_across(close, texts_of(close, nodes, docs, id_col, text), similarity, weighting, agreement), "near-more-links")
    if not more.isEmpty():
        labels = components(labels.select("u", "v").unionByName(more))

    grouped = nodes.join(labels.select(F.col("v").alias("key"), "u"), "key", "left").select("key", "row", "id", F.coalesce("u", "key").alias("u"))
    kept = grouped.groupBy("u").agg(F.min("id").alias("class_id"), F.min_by("row", F.struct(F.col("id").isNull(), "id", "row")).alias("keeper"))
    by_key = grouped.join(kept, "u").select(F.col("key").alias("k"), "class_id", "keeper")
    return rows.join(by_key, F.col("key") == F.col("k")).select("row", "id", "key", "class_id", "keeper")


def dedup_near(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, weighting: str = "count", agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """One row of each class of ``near_classes``, the one of the smallest id; of equal rows one.  All columns stay; an empty table gives no rows."""
    classes = near_classes(docs, id_col=id_col, text=text, similarity=similarity, weighting=weighting, agreement=agreement)
    own, first = f"{OWN}row", F.row_number().over(Window.partitionBy(f"{OWN}row").orderBy(F.lit(1)))
    keepers = classes.where("row = keeper").select(F.col("row").alias(own)).distinct()
    kept = docs.withColumn(own, row_key(id_col, text)).join(keepers, own).withColumn(f"{OWN}n", first).where(F.col(f"{OWN}n") == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
