"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every source gets a target number of words.  A document of a source should then be taken
``target / source_size`` times.  The whole part of that is taken outright; the fractions are
rounded dependently: two documents' fractions meet, and mass (in words) moves from one to the
other, in a random direction that keeps both expectations, until one of them is 0 or 1.  The one
that stays fractional meets the next document.  A block of about 32 documents ends with one
fraction at most; the blocks of a source form the leaves of a reduction tree of fan-in 32, whose
nodes pair what their children left, so no task ever holds more than a small block and a source
that has a third of all rows is spread like any other.  A node meets its documents largest first,
so that what it leaves tends to be small.  Only the fraction left at a source's root is rounded to
the nearer whole, so a source misses its target by half of one document at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import OWN, row_hash, settled

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in a leaf block on average, and children of an inner node.
FAN_IN = 32
#: Rows in a part of the order that numbers the rows of an id, on average.
PART = 20_000

ITEM = "struct<d:bigint,o:int,p:double,s:double,u:double>"
#: One meeting of the carried fraction (acc) with the next (it).  ``toward`` moves mass from ``it`` to ``acc``.
MEET = """
(acc, it) -> if(acc.o is null,
  named_struct('d', it.d, 'o', it.o, 'p', it.p, 's', it.s, 'out', acc.out),
  if(it.u * (least((1 - acc.p) * acc.s, it.p * it.s) + least(acc.p * acc.s, (1 - it.p) * it.s)) < least(acc.p * acc.s, (1 - it.p) * it.s),
    if((1 - acc.p) * acc.s <= it.p * it.s,
      named_struct('d', it.d, 'o', it.o, 'p', it.p - (1 - acc.p) * acc.s / it.s, 's', it.s, 'out', array_append(acc.out, named_struct('d', acc.d, 'o', acc.o, 'up', 1))),
      named_struct('d', acc.d, 'o', acc.o, 'p', acc.p + it.p * it.s / acc.s, 's', acc.s, 'out', array_append(acc.out, named_struct('d', it.d, 'o', it.o, 'up', 0)))),
    if(acc.p * acc.s <= (1 - it.p) * it.s,
      named_struct('d', it.d, 'o', it.o, 'p', it.p + acc.p * acc.s / it.s, 's', it.s, 'out', array_append(acc.out, named_struct('d', acc.d, 'o', acc.o, 'up', 0))),
      named_struct('d', acc.d, 'o', acc.o, 'p', acc.p - (1 - it.p) * it.s / acc.s, 's', acc.s, 'out', array_append(acc.out, named_struct('d', it.d, 'o', it.o, 'up', 1))))))
"""
START = "named_struct('d', cast(null as bigint), 'o', cast(null as int), 'p', cast(0 as double), 's', cast(0 as double), 'out', cast(array() as array<struct<d:bigint,o:int,up:int>>))"


def unit(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone: 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, n, target) from rows of (source, size).

    Sources stand by code point, null last, and weigh ``weights`` in turn.  ``share`` of all sizes is
    dealt by weight; no target exceeds ``cap`` times its source's size, and what is cut off is dealt
    again by weight.  That fixed point is ``min(cap * size, level * weight)``: with sources by rising
    ``cap * size / weight``, those before some point are capped and the level follows from sums over
    that order.  The windows run over one row a source.
    """
    per = sizes.groupBy(source).agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col(source).asc_nulls_last())
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col(source).asc_nulls_last())
    before, all_rows = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    per = per.withColumn("capped", F.col("cap") < F.col("level") * F.col("w"))
    level = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), F.col(source).isNull(), F.col(source)))).over(all_rows)
    return per.select(source, "source_size", "n", F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w"))).alias("target"))


def content_hash(docs: DataFrame) -> Column:
    """``row_hash`` that also tells apart which columns are null."""
    return F.xxhash64(row_hash(docs), *[F.col(f"`{c}`").isNull() for c in docs.columns])


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (d, source, size, h) with ``o``: the number of each among those of its ``d``, from 1, by size, source and h.

    All rows are laid in that order in range parts; a row's number is its place among its id's rows of
    the part and the count of those in parts before, so an id of many rows is no task of its own.
    Rows equal in all of these are told apart by a number that only serves to spread them.
    """
    rows = settled(rows.withColumn("tie", F.monotonically_increasing_id()), "mix-sized")
    parts = max(1, rows.count() // PART)
    order = [F.col("size"), F.col("source").asc_nulls_last(), F.col("h"), F.col("tie")]
    laid = settled(rows.repartitionByRange(parts, F.col("d"), *order).withColumn("part", F.spark_partition_id()), "mix-laid")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = laid.groupBy("d", "part").agg(F.count("*").alias("n")).withColumn("before", before).where("before > 0").select(F.col("d").alias("b_d"), F.col("part").alias("b_part"), "before")
    placed = laid.withColumn("o", F.row_number().over(Window.partitionBy("d", "part").orderBy(*order)))
    placed = placed.join(offsets, F.col("d").eqNullSafe(F.col("b_d")) & (F.col("part") == F.col("b_part")), "left")
    return placed.select("d", "source", "size", "h", (F.col("o") + F.coalesce("before", F.lit(0))).cast("int").alias("o"))


def mix_plan(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """How many times the mix takes each row: (id, occ, size, source_size, target, copies).

    ``occ`` numbers the rows of one id from 1, by size, source and content, so equal rows are counted
    apart and a rerun numbers rows with different contents alike.  ``copies`` is at most ``cap`` rounded up.
    A null text has size 0; a row of size 0 is taken 0 times, and so is every row of a source whose
    size is 0.  A null source is a source of its own.  An empty table gives an empty plan.
    """
    return hashed_plan(docs, id_col, text, source, weights, share, cap, seed).drop("h")


def hashed_plan(docs: DataFrame, id_col: str, text: str, source: str, weights: Sequence[float], share: float, cap: float, seed: str) -> DataFrame:
    """``mix_plan`` with ``h``, the row's ``content_hash``."""
    rows = settled(numbered(docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{source}`").alias("source"), word_count(text).alias("size"), content_hash(docs).alias("h"))), "mix-rows")
    targets = settled(source_targets(rows, "source", weights, share, cap), "mix-targets")
    most = targets.agg(F.max("n")).first()[0] or 0
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "n")
    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    placed = rows.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source").withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0)))
    placed = placed.withColumn("base", F.floor("rate").cast("int")).withColumn("p", F.col("rate") - F.col("base"))
    pool = placed.where((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", F.floor(unit(F.lit(seed), F.col("d"), F.col("o"), F.lit("block")) * F.ceil(F.col("n") / FAN_IN)).alias("block"),
        F.struct("d", "o", "p", F.col("size").cast("double").alias("s"), unit(F.lit(seed), F.col("d"), F.col("o"), F.lit(1)).alias("u")).cast(ITEM).alias("item"),
    )
    decided, blocks, level = [], -(-most // FAN_IN), 1
    while True:
        met = pool.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct((-F.col("item.s")).alias("s"), F.col("item.u"), F.col("item.d"), F.col("item.o"), F.col("item")))).alias("items"))
        node = settled(met.select("source", "block", F.expr(f"aggregate(transform(items, x -> x.item), {START}, {MEET})").alias("node")), f"mix-level{level}")
        decided.append(node.select(F.explode("node.out").alias("x")).select("x.d", "x.o", "x.up"))
        if blocks <= 1:
            break
        blocks, level = -(-blocks // FAN_IN), level + 1
        item = F.struct(F.col("node.d"), F.col("node.o"), F.col("node.p"), F.col("node.s"), unit(F.lit(seed), F.col("node.d"), F.col("node.o"), F.lit(level)).alias("u"))
        pool = node.select("source", F.floor(F.col("block") / FAN_IN).alias("block"), item.cast(ITEM).alias("item"))
    decided.append(node.select(F.col("node.d").alias("d"), F.col("node.o").alias("o"), (F.col("node.p") >= 0.5).cast("int").alias("up")))
    ups = decided[0]
    for more in decided[1:]:
        ups = ups.unionByName(more)
    ups = ups.select(F.col("d").alias("u_d"), F.col("o").alias("u_o"), "up")
    joined = placed.join(ups, F.col("d").eqNullSafe(F.col("u_d")) & (F.col("o") == F.col("u_o")), "left")
    return joined.select(F.col("d").alias(id_col), "h", F.col("o").alias("occ"), "size", "source_size", "target", (F.col("base") + F.coalesce(F.col("up"), F.lit(0))).alias("copies"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``mix_plan`` takes it, with its own columns.

    Rows that are equal in all columns are taken as one, as often as all of them together.
    """
    key, own = f"{OWN}key", f"{OWN}copies"
    plan = hashed_plan(docs, id_col, text, source, weights, share, cap, seed)
    total = plan.where("copies > 0").groupBy(content_key(F.col(f"`{id_col}`"), F.col("h")).alias(key)).agg(F.sum("copies").cast("int").alias(own))
    marked = docs.withColumn(key, content_key(F.col(f"`{id_col}`"), content_hash(docs)))
    one = marked.withColumn(f"{OWN}n", F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1)))).where(F.col(f"{OWN}n") == 1)
    return one.join(total, key).withColumn(f"{OWN}copy", F.explode(F.sequence(F.lit(1), F.col(own)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def content_key(d: Column, h: Column) -> Column:
    return F.concat_ws("|", h, F.coalesce(d.cast("string"), F.lit("~")))


def oracle(levels: int = 4) -> str:
    """``mix_plan`` of documents in DuckDB's SQL, with the default options.

    ``levels`` of the tree serve up to FAN_IN ** levels documents a source; levels beyond a source's
    root leave it as it is.
    """

    def unit_of(d: str, o: str, salt: object) -> str:
        return f"('0x' || substr(md5(concat_ws('|', 'mix', coalesce({d}::varchar, '~'), {o}::varchar, '{salt}')), 1, 8))::bigint / 4294967296.0::double"

    def carry(who: str, p: str, settled_one: str, up: int) -> str:
        return f"{{'d': {who}.d, 'o': {who}.o, 'p': {p}, 's': {who}.s, 'u': it.u, 'out': list_append(acc.out, {{'d': {settled_one}.d, 'o': {settled_one}.o, 'up': {up}}})}}"

    toward, away = "least((1 - acc.p) * acc.s, it.p * it.s)", "least(acc.p * acc.s, (1 - it.p) * it.s)"
    meet = f"""case when it.u * ({toward} + {away}) < {away}
      then case when (1 - acc.p) * acc.s <= it.p * it.s then {carry("it", "it.p - (1 - acc.p) * acc.s / it.s", "acc", 1)} else {carry("acc", "acc.p + it.p * it.s / acc.s", "it", 0)} end
      else case when acc.p * acc.s <= (1 - it.p) * it.s then {carry("it", "it.p + acc.p * acc.s / it.s", "acc", 0)} else {carry("acc", "acc.p - (1 - it.p) * it.s / acc.s", "it", 1)} end end"""
    none = "[]::struct(d bigint, o bigint, up integer)[]"
    sql = f"""
with sized as (select doc_id as d, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size from documents),
numbered as (select *, row_number() over (partition by d order by size, source nulls last) as o from sized),
per as (select source, sum(size)::bigint as source_size, count(*) as n, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as w from sized group by source),
capped as (select *, source_size * 2.0::double as cap from per),
levels as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over rising, 0)) / (sum(w) over () - coalesce(sum(w) over rising, 0)) as level from capped
  window rising as (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (select source, source_size, n, case when cap < level * w then cap else least(cap, (select arg_min(level, (cap / w, source is null, source)) from levels where cap >= level * w) * w) end as target from levels),
placed as (select r.*, t.source_size, t.n, t.target, case when r.size > 0 then t.target / nullif(t.source_size, 0) else 0.0 end as rate from numbered r join targets t on r.source is not distinct from t.source),
based as (select *, floor(rate)::int as base, rate - floor(rate)::int as p from placed),
pool1 as (select source, floor({unit_of("d", "o", "block")} * ceil(n / {FAN_IN}.0))::bigint as block, {{'d': d, 'o': o, 'p': p, 's': size::double, 'u': {unit_of("d", "o", 1)}, 'out': {none}}} as item from based where p > 0 and size > 0)"""
    for k in range(1, levels + 1):
        sql += f""",
node{k} as (select source, block, list_reduce(list(item order by item.s desc, item.u, item.d, item.o), lambda acc, it: {meet}) as x from pool{k} group by source, block),
pool{k + 1} as (select source, block // {FAN_IN} as block, {{'d': x.d, 'o': x.o, 'p': x.p, 's': x.s, 'u': {unit_of("x.d", "x.o", k + 1)}, 'out': {none}}} as item from node{k})"""
    decided = " union all ".join(f"select unnest(x.out) as y from node{k}" for k in range(1, levels + 1))
    return f"""{sql},
ups as (select y.d as d, y.o as o, y.up as up from ({decided}) union all select x.d, x.o, (x.p >= 0.5)::int from node{levels})
select b.d as doc_id, b.size::bigint as size, b.source_size, b.target, (b.size * (b.base + coalesce(u.up, 0)))::bigint as taken
from based b left join ups u on b.d is not distinct from u.d and b.o = u.o"""
