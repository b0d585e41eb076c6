"""The trie of conversations' prefixes, with totals of every subtree by parallel tree contraction.

A conversation is its turns in order; each distinct sequence of first turns is a node, named by a hash of
127 bits: the turns' SHA-256 digests are the digits of a number to a fixed base, modulo a prime.  Such
hashes of two runs of turns combine into that of both, so a conversation may lie across many sorted
parts: each part is scanned from nothing, and a part that goes on with a conversation gets what its
earlier parts come to (at most one such carry a part).

Totals of subtrees are sums over children, children's children and so on.  Round by round, all leaves are
raked (their totals go to their parents), and of the unary chains that are left a third of the nodes, no
two of them neighbours, are compressed (the only child hangs on to the node's parent, with the
node's sum on its edge).  So rounds grow with the logarithm of the depth, not with the depth.  When the root
alone is left the rounds are walked back, and each compressed node's total is its child's and its own sum.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled

#: Turns that are taken over from a conversation's base are fewer than this.
TAKEN = 9
PRIME, BASE, ROOT = (1 << 127) - 1, 0x5A3C96E1B47D2F08C1E59A7B3D64F20F, 1
#: Ids of a node's members that are joined to one piece of text at a time.
PIECE = 4096

_SCANNED = "conv long, part int, depth long, node binary, parent binary, bytes long, last boolean, edge boolean"


def named(h: int) -> bytes:
    return h.to_bytes(16, "big")


def digested(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, digest, bytes, row): the digest is of the role's length, the role and the text; rows are numbered."""
    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(part(role)).cast("string"), F.lit(":"), part(role), part(text)), 256))
    out = rows.where(F.col(f"`{conv}`").isNotNull()).select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.octet_length(part(text)).cast("long").alias("bytes"))
    return settled(out.withColumn("row", F.monotonically_increasing_id()), "trie-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, own, turn, digest, row, bytes) of every rebuilt conversation's turns; ``own`` is false for those of its base, which come first."""
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(TAKEN))
    base = F.col("conv") - F.expr("conv % 5")
    at = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest", "row"))
    # no more than the first turns are ever numbered, so a long conversation is cut down before its rows meet
    first = settled(turns.withColumn("at", at).where(F.col("at") < TAKEN), "trie-first")
    convs = turns.select("conv").distinct().where("conv % 5 <> 0").select("conv", base.alias("base"), h.alias("h"))
    lent = convs.join(first.withColumnRenamed("conv", "base"), "base").where("at <= h").select("conv", F.lit(False).alias("own"), "turn", "digest", "row", "bytes")
    gone = first.where((F.expr("conv % 5") != 0) & (F.col("at") <= h)).select("row")
    kept = turns.join(gone, "row", "left_anti").select("conv", F.lit(True).alias("own"), "turn", "digest", "row", "bytes")
    return kept.unionByName(lent)


def scanned(rows: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, bytes, last): each turn with the node that it leads to; ``last`` is true of a conversation's last turn."""
    order = ["conv", "own", F.asc_nulls_first("turn"), "digest", "row"]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv", "digest", "bytes", F.spark_partition_id().alias("part"))

    def scan(batches: Iterator) -> Iterator:
        """Hashes from nothing on; a row is held back until it is known whether its conversation goes on."""
        import pyarrow as pa

        conv, h, depth, part, before, out = None, ROOT, 0, 0, None, []
        names = [c.split()[0] for c in _SCANNED.split(", ")]

        def batch():
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for b in batches:
            for c, digest, size, part in zip(*(b.column(x).to_pylist() for x in ("conv", "digest", "bytes", "part"))):
                if before is not None:
                    out.append((*before[:6], c != conv, before[7]))
                if c != conv:
                    edge, conv, h, depth = conv is None, c, ROOT, 0  # an edge: it may go on from the part before
                parent, h, depth = h, (h * BASE + int.from_bytes(digest, "big")) % PRIME, depth + 1
                before = (c, part, depth, named(h), named(parent), size, None, edge)
            if out:
                yield batch()
                out = []
        if before is not None:
            out = [(*before[:6], None, before[7])]
            yield batch()

    local = settled(ordered.mapInArrow(scan, _SCANNED), "trie-scanned")
    # each part's last row, and the last of what it began with: two rows a part at most
    ends = local.where("last is null or (edge and last)").select("part", "conv", "depth", "node", "last", "edge").orderBy("part", F.asc_nulls_last("last")).collect()
    carry, goes_on, known = {}, {}, {}
    for r in ends:
        if r.edge and r.conv == known.get("conv"):  # this part goes on with the conversation that the parts before ended with
            carry[r.part] = (known["h"], known["depth"])
            goes_on[known["part"]] = True
        h, depth = carry.get(r.part, (ROOT, 0)) if r.edge else (ROOT, 0)
        if r["last"] is None:
            known = {"conv": r.conv, "part": r.part, "depth": depth + r.depth, "h": (h * pow(BASE, r.depth, PRIME) + int.from_bytes(r.node, "big") - ROOT * pow(BASE, r.depth, PRIME)) % PRIME}

    def carried(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            columns = {x: b.column(x).to_pylist() for x in b.schema.names}
            for i, (part, edge, last) in enumerate(zip(columns["part"], columns["edge"], columns["last"])):
                if last is None:
                    columns["last"][i] = not goes_on.get(part, False)
                if edge and part in carry:
                    h, d = carry[part]
                    for x, less in (("node", 0), ("parent", 1)):
                        power = pow(BASE, columns["depth"][i] - less, PRIME)
                        columns[x][i] = named((int.from_bytes(columns[x][i], "big") + (h - ROOT) * power) % PRIME)
                    columns["depth"][i] += d
            yield pa.RecordBatch.from_arrays([pa.array(columns[x], b.schema.field(x).type) for x in ("conv", "depth", "node", "parent", "bytes", "last")], ["conv", "depth", "node", "parent", "bytes", "last"])

    return local.mapInArrow(carried, "conv long, depth long, node binary, parent binary, bytes long, last boolean")


def digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv): the SHA-256 of each node's ids, ascending and joined by commas.

    Ids are sorted by ranges and joined to pieces there, so a node's ids are hashed from a stream of few rows.
    """
    parts = max(1, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        node, held = None, []

        def piece():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], ["node", "first", "ids"])

        for b in batches:
            for n, c in zip(b.column("node").to_pylist(), b.column("conv").to_pylist()):
                if held and (n != node or len(held) == PIECE):
                    yield piece()
                    held = []
                node = n
                held.append(c)
        if held:
            yield piece()

    def digest(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        node, state = None, None
        for b in batches:
            out = []
            for n, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if n != node:
                    if state:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    pieces = settled(ends.repartitionByRange(parts, "node", "conv").sortWithinPartitions("node", "conv").select("node", "conv").mapInArrow(join, "node binary, first long, ids string"), "trie-pieces")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def subtree_totals(nodes: DataFrame, sums: tuple[str, ...]) -> DataFrame:
    """(node, ``sums``): for each node of (node, parent, ``sums``) the sums over its subtree, which it is part of.

    One node has a null parent, the root; from every other it is reached by parents.
    """
    own, on_edge, up = ([f"{kind}_{c}" for c in sums] for kind in ("own", "edge", "up"))
    spec = lambda columns: ", ".join(columns)
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n"))
    live = settled(nodes.join(kids, "node", "left").select("node", "parent", F.coalesce("n", F.lit(0)).alias("n"), *(F.col(c).alias(o) for c, o in zip(sums, own)), *(F.lit(0).cast("long").alias(e) for e in on_edge)), "trie-live")
    raked, compressed = [], []
    while live.count() > 1:
        # rake: leaves give their sums to their parents
        leaf = F.col("n") == 0
        gifts = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.sum(F.when(leaf, 0).otherwise(1)).alias("left"), F.max(F.when(~leaf, F.col("node"))).alias("child"),
            *(F.sum(F.when(leaf, F.col(o) + F.col(e)).otherwise(0)).alias(u) for o, e, u in zip(own, on_edge, up)),
        )
        raked.append(live.where(leaf).select("node", *own))
        stand = live.where(~leaf).join(gifts, "node", "left").select("node", "parent", F.col("left").alias("n"), "child", *((F.col(o) + F.col(u)).alias(o) for o, u in zip(own, up)), *on_edge)
        # compress: of neighbours on a chain the one of the smaller hash goes, so never two of them
        rank = lambda c: F.xxhash64(c, F.lit(len(raked)))
        goes = F.col("parent").isNotNull() & (F.col("n") == 1) & (rank("node") < rank("child")) & (rank("node") < rank("parent"))
        stand = settled(stand.withColumn("goes", F.coalesce(goes, F.lit(False))), "trie-stand")
        out = stand.where("goes")
        moved = out.select(F.col("node").alias("parent"), F.col("parent").alias("above"), *((F.col(o) + F.col(e)).alias(u) for o, e, u in zip(own, on_edge, up)))
        joined = stand.where("not goes").join(moved, "parent", "left")
        edges = [(F.col(e) + F.coalesce(u, F.lit(0))).alias(e) for e, u in zip(on_edge, up)]
        following = settled(joined.select("node", F.coalesce("above", "parent").alias("parent"), "n", *own, *edges), "trie-live")
        # what lay on the child's edge belongs to the compressed node
        child = stand.select(F.col("node").alias("child"), *(F.col(e).alias(u) for e, u in zip(on_edge, up)))
        compressed.append(out.select("node", "child", *own).join(child, "child").select("node", "child", *((F.col(o) + F.col(u)).alias(o) for o, u in zip(own, up))))
        live = following
    totals = live.select("node", *own)
    for leaves, chain in zip(reversed(raked), reversed(compressed)):
        below = totals.select(F.col("node").alias("child"), *(F.col(o).alias(u) for o, u in zip(own, up)))
        opened = chain.join(below, "child").select("node", *((F.col(o) + F.col(u)).alias(o) for o, u in zip(own, up)))
        totals = settled(totals.unionByName(opened).unionByName(leaves), "trie-totals")
    return totals.select("node", *(F.col(o).alias(c) for o, c in zip(own, sums)))


def prefix_trie(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn`` (null first), those of one number by the SHA-256 of role and text; a
    null role or text is empty.  A conversation c takes the first h turns of conversation c - c % 5
    (remainders have the sign of c) in place of its own first h, where h is crc32 of c in decimals modulo
    9.  Rows without a conversation take no part.  Repeated rows are turns of their own.  Columns other
    than these four play no part.  An empty table gives no rows; a conversation that is left without
    turns is a member of the root alone.
    """
    turns = digested(rows, conv, turn, role, text)
    walk = settled(scanned(rebuilt(turns)), "trie-walk")
    convs = turns.select("conv").distinct()
    root = F.lit(bytearray(named(ROOT)))
    # the columns but the id are the same for all members of a node
    grown = walk.groupBy("node", "parent", "depth", "bytes").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"))
    top = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(root.alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), "conv_id", "n_convs")
    plain = settled(grown.unionByName(top), "trie-plain")
    kids = plain.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = settled(plain.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    weighed = nodes.select("node", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(weighed, ("n_leaves", "saved_tokens"))
    last = walk.where("last").select("node", "conv")
    ends = digests(last.unionByName(convs.join(last.select("conv"), "conv", "left_anti").select(root.alias("node"), "conv")))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(above, "parent", "left").join(totals, "node").join(ends, "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def oracle() -> str:
    """DuckDB SQL of ``prefix_trie`` over ``conversations``: every node against every member's prefix, so for small tables."""
    steps = ", ".join(["-1"] * 8)
    return f"""
with turns as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos,
    {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as said
  from conversations where conv_id is not null),
convs as (
  select c, xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, {steps}])),
    lambda a, b: case when b >= 0 then xor(a, b) when a & 1 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end), 4294967295::bigint) % 9 as h
  from (select distinct c from turns)),
whole as (
  select v.c, list(t.said order by t.c <> v.c - v.c % 5, t.pos) as said
  from convs v join turns t on (v.c % 5 = 0 and t.c = v.c) or (v.c % 5 <> 0 and ((t.c = v.c - v.c % 5 and t.pos <= v.h) or (t.c = v.c and t.pos > v.h)))
  group by v.c),
members as (
  select c, d, said[:d] as prefix, d = len(said) as ends from (select v.c, coalesce(w.said, []) as said, unnest(range(len(coalesce(w.said, [])) + 1)) as d from convs v left join whole w on v.c = w.c)),
named as (select *, min(c) over (partition by d, prefix) as conv from members),
nodes as (
  select conv, d, count(*) as n_convs, strlen(any_value(prefix[d].t)) as bytes, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256
  from named group by conv, d),
parents as (select n.*, p.conv as parent from nodes n left join named p on p.c = n.conv and p.d = n.d - 1),
kids as (select parent as conv, d - 1 as d, count(*) as n_children from parents where d > 0 group by all),
grown as (select p.*, coalesce(k.n_children, 0) as n_children from parents p left join kids k on p.conv = k.conv and p.d = k.d),
totals as (
  select a.conv, a.d, sum((g.n_children = 0)::int) as n_leaves, sum((g.n_convs - 1) * coalesce(g.bytes, 0)) as saved
  from grown g join named a on a.c = g.conv and a.d <= g.d group by a.conv, a.d)
select g.conv as conv_id, g.d as depth, g.parent as parent_conv_id, g.n_convs, g.n_children, t.n_leaves::bigint as n_leaves, t.saved::bigint as saved_tokens, g.ends_sha256
from grown g join totals t on g.conv = t.conv and g.d = t.d"""
