"""How the words of one source differ from those of others, by chunk factorization.

Documents are cut into chunks at ASCII whitespace, which no term crosses.  Chunks are counted document by
document, and added up within a bounded run of documents: for a language and chunk, the documents that hold
it, and its occurrences in each source.  Each globally distinct chunk is cut into terms once, and its terms are
joined back to the chunks' sums; a chunk without an ASCII character but small letters is a term as it stands.

A document may have a term in several chunks.  The chunk that most documents of the language have bounds a
term's documents from below, the sum over its chunks from above.  Where the wanted number lies between the
two no chunk of the term is in that many documents, and of such chunks the documents' numbers are kept, so they are
joined and counted.  Terms that cannot be in that many documents go before their occurrences are written.

Sources are compared in tiles: a block of sources against another over a block of terms, as arrays of
whole numbers, so no row is made for a pair of sources and a term.  Terms that neither of two sources has
weigh the same for all of them, and enter by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.shared import settled, shuffles_freed

#: A term: no ASCII character but letters.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: In a chunk that is no term as it stands: an ASCII character but a small letter.
OTHER = r"[\x00-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text whose chunks are added up at a time.
RUN = 1 << 25
#: Sources in a block, rows of terms that a tile gets on average, and terms at a time inside it.
SOURCES, TERMS, STEP = 64, 20_000, 256
SCALE = 1_000_000_000

_GROUP = ("lang", "source")


def summed(no, lang, text, first: int, least: int):
    """The rows of ``chunked`` of one run of documents, numbered from ``first``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    order = pc.sort_indices(no)  # so that a chunk's documents come source by source
    no, lang, text = no.take(order).to_numpy(), lang.take(order).dictionary_encode(), text.take(order)
    cut = pc.ascii_split_whitespace(text)
    chunks = cut.flatten().dictionary_encode()
    codes, names = chunks.indices.to_numpy(), chunks.dictionary
    doc = np.repeat(np.arange(len(no)), cut.value_lengths().to_numpy())
    fine = codes != pc.index(names, "").as_py()  # at a text's ends
    k = max(1, len(names))
    pairs, n = np.unique(doc[fine] * k + codes[fine], return_counts=True)
    doc, code = np.divmod(pairs, k)
    key = lang.indices.to_numpy().astype(np.int64)[doc] * k + code
    order = np.argsort(key, kind="stable")
    key, doc, n = key[order], doc[order], n[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    held = np.diff(starts, append=len(key))
    split = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(no[doc], prepend=-1) != 0))
    sources = no[doc[split]] << 32 | (np.add.reduceat(n, split) if len(split) else n)
    rare = held < least
    listed = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))
    by_source = listed(np.append(np.searchsorted(split, starts), len(split)), sources)
    ids = listed(np.concatenate([[0], np.cumsum(np.where(rare, held, 0))]), first + doc[np.repeat(rare, held)])
    columns = [lang.dictionary.take(pa.array(key[starts] // k)), names.take(pa.array(key[starts] % k)), pa.array(held), by_source, ids]
    return pa.RecordBatch.from_arrays(columns, ["lang", "chunk", "docs", "sources", "ids"])


def chunked(docs: DataFrame, least: int) -> DataFrame:
    """(lang, chunk, docs, sources, ids) of (no, lang, text): documents with a chunk, its occurrences in each source, and those documents' numbers if under ``least``.

    An element of ``sources`` is a source's number times 2**32, and the occurrences.  A language and chunk have a row for each run of documents.
    """

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        first, held, size = TaskContext.get().partitionId() << 40, [], 0

        def given():
            no, lang, text = (pa.concat_arrays([b.column(c) for b in held]) for c in ("no", "lang", "text"))
            return summed(no, lang, text, first, least)

        for batch in batches:
            at, lengths = 0, np.array(pc.binary_length(batch.column("text")), np.int64)
            while at < len(batch):
                take = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), RUN - size, "right")))
                held.append(batch.slice(at, take))
                size += int(lengths[at : at + take].sum())
                at += take
                if size >= RUN or at < len(batch):
                    yield given()
                    first, held, size = first + sum(map(len, held)), [], 0
        if held:
            yield given()

    return docs.select("no", "lang", "text").mapInArrow(count, "lang string, chunk string, docs long, sources array<long>, ids array<long>")


def counted(docs: DataFrame, least: int) -> DataFrame:
    """(no, lang, term, n): occurrences in each source of the terms in ``least`` documents of the language."""
    rows = settled(chunked(docs, least), "divergence-chunks")
    cut, other = F.explode(F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), 0)), F.col("chunk").rlike(OTHER)
    terms = settled(rows.select("chunk").where(other).distinct().select("chunk", cut.alias("term")), "divergence-terms")

    # dealt by chunk, which serves the window and the join with the terms alike; a row's documents are added once, with its first source
    sums = rows.select("lang", "chunk", "docs", "sources").repartition("chunk").withColumn("most", F.sum("docs").over(Window.partitionBy("chunk", "lang")))
    each = sums.join(terms, "chunk", "left").withColumn("term", F.coalesce("term", F.when(~other, F.col("chunk")))).where("term is not null")
    each = each.select("lang", "term", "docs", "most", F.posexplode("sources").alias("pos", "source"))
    each = each.select(F.shiftrightunsigned("source", 32).alias("no"), "lang", "term", F.col("source").bitwiseAND(F.lit(0xFFFFFFFF)).alias("n"), F.when(F.col("pos") == 0, F.col("docs")).otherwise(0).alias("docs"), "most")
    counts = settled(each.groupBy("no", "lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.max("most").alias("most")), "divergence-counts")

    # a term has a row for each of its sources here
    term = Window.partitionBy("lang", "term")
    bounds = counts.select("no", "lang", "term", "n", F.sum("docs").over(term).alias("docs"), F.max("most").over(term).alias("most")).where(F.col("docs") >= least)
    counts = settled(bounds.select("no", "lang", "term", "n", (F.col("most") >= least).alias("sure")), "divergence-bounds")

    unsure = settled(counts.where("not sure").select("lang", "term").distinct(), "divergence-open")
    chunks = terms.join(unsure.hint("merge"), "term")  # it grows with the input, so it is never broadcast
    chunks = chunks.select("chunk", "lang", "term").unionByName(unsure.select(F.col("term").alias("chunk"), "lang", "term"))
    exact = rows.select("lang", "chunk", "ids").join(settled(chunks, "divergence-unsure"), ["chunk", "lang"]).select("lang", "term", F.explode("ids").alias("id")).distinct()
    exact = exact.groupBy("lang", "term").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    found = counts.where("not sure").join(exact.select("lang", "term"), ["lang", "term"])
    return counts.where("sure").drop("sure").unionByName(found.drop("sure"))


def share(n: str, total: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exactly."""
    return F.expr(f"cast(1 + (cast({SCALE} as decimal(10)) * cast({n} + 2 as decimal(19))) div cast({total} + 2 * terms as decimal(20)) as bigint)")


def pair_sums(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value, met): sums over the terms that any of a tile's sources has; ``met`` is how many those are.

    ``terms`` are (lang, no, term, p), ``groups`` (lang, no, p0) with the p of a term that the group has not.
    """
    rows = F.count("*") / TERMS
    parts = settled(terms.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(rows)).cast("int").alias("parts")), "divergence-parts")
    block = (F.col("no") / SOURCES).cast("int")
    width = groups.groupBy("lang").agg(F.max(block).alias("widest"))
    # a block of sources takes part in its tiles with every block, and of (a, b) and (b, a) the one with a <= b is made
    tiles = F.explode(F.sequence(F.lit(0), F.col("widest")))
    tile = lambda df: df.withColumn("own", block).withColumn("other", tiles).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    left = tile(terms.join(parts, "lang").join(width, "lang")).select("lang", "i", "j", F.pmod(F.xxhash64("term"), "parts").alias("part"), "no", "term", "p")
    right = tile(groups.join(parts, "lang").join(width, "lang")).select("lang", "i", "j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"), F.col("no").alias("no_"), "p0")

    def run(key, rows, sources):
        import numpy as np
        import pandas as pd

        if not len(rows) or not len(sources):
            return pd.DataFrame({"lang": [], "a": [], "b": [], "value": [], "met": []}).astype({"lang": str, "a": np.int64, "b": np.int64, "value": np.int64, "met": np.int64})
        _, i, j, _ = key
        nos, p0 = sources["no_"].to_numpy(), sources["p0"].to_numpy()
        order = np.argsort(nos)
        nos, p0 = nos[order], p0[order]
        term, at = np.unique(rows["term"].to_numpy(), return_inverse=True)[1], np.searchsorted(nos, rows["no"].to_numpy())
        n = term.max() + 1 if len(term) else 0
        dense = np.broadcast_to(p0, (n, len(nos))).copy()
        dense[term, at] = rows["p"].to_numpy()
        a, b = np.flatnonzero(nos // SOURCES == i), np.flatnonzero(nos // SOURCES == j)
        total = np.zeros((len(a), len(b)), np.int64)
        for k in range(0, n, STEP):
            p, q = dense[k : k + STEP, a, None], dense[k : k + STEP, None, b]
            total += ((p - q) ** 2 // (p + q)).sum(axis=0)
        x, y = (g.ravel() for g in np.meshgrid(a, b, indexing="ij"))
        both = x != y
        x, y, total = x[both], y[both], total.ravel()[both]
        out = pd.DataFrame({"lang": key[0], "a": nos[x], "b": nos[y], "value": total, "met": n})
        return out if i == j else pd.concat([out, out.rename(columns={"a": "b", "b": "a"})])

    keys = ("lang", "i", "j", "part")
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "lang string, a long, b long, value long, met long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and the terms it has more of.

    A term is a run of characters that are no ASCII but letters; only A to Z are lower-cased.  A language
    keeps the terms of at least ``least`` of its documents.  A null text, language or source is an empty one; each row
    is a document, repeated or not; texts of any length are counted whole.  A source whose documents
    have no kept term takes part with counts of nought; where a language keeps none, its pairs are 0.
    Columns other than these three play no part, and an empty table gives no rows.
    """
    given = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))))
    # a row a source of a language; the result has a row for each two of them
    no = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")
    named = settled(given.select(*_GROUP).distinct().withColumn("no", no), "divergence-sources")
    with shuffles_freed(docs.sparkSession):
        kept = settled(counted(given.join(named, [*_GROUP]).select("no", "lang", "text"), least), "divergence-kept")
    whole = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    terms = whole.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "no").agg(F.sum("n").alias("total"))
    groups = named.join(totals, ["lang", "no"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = settled(groups.withColumn("p0", F.when(F.col("terms") > 0, share("0", "total")).otherwise(0)), "divergence-groups")
    shares = kept.join(whole, ["lang", "term"]).join(groups.drop("p0"), ["lang", "no"])
    weighed = settled(shares.select(*_GROUP, "no", "term", share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q")), "divergence-weighed")
    f = lambda p, q: F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")

    found = pair_sums(weighed.select("lang", "no", "term", "p"), groups.select("lang", "no", "p0"))
    one = groups.select("lang", F.col("source").alias("source"), F.col("no").alias("a"), F.col("p0").alias("p"), "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("no").alias("b"), F.col("p0").alias("q"))
    rest = F.when(F.col("terms") > 0, (F.col("terms") - F.coalesce("met", F.lit(0))) * f("p", "q")).otherwise(0)
    pairs = one.join(other, "lang").where("a <> b").join(found, ["lang", "a", "b"], "left").select(*_GROUP, F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + rest).cast("long").alias("value"))
    more = weighed.where("p > q").select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), f("p", "q").cast("long").alias("value"))
    place = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", place).unionByName(more.withColumn("rank", place).where(F.col("rank") <= top))


def oracle(least: int = 10, top: int = 10) -> str:
    """DuckDB SQL of ``audit`` over ``documents``."""
    share = lambda n, total: f"1 + ({SCALE} * ({n} + 2)::hugeint) // ({total} + 2 * v)"
    return f"""
with docs as (select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
words as (select doc, lang, source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term from docs),
kept as (select lang, term, count(*) as n from words group by all having count(distinct doc) >= {least}),
langs as (select l.lang, count(k.term) as v, coalesce(sum(n), 0) as n from (select distinct lang from docs) l left join kept k on k.lang = l.lang group by l.lang),
groups as (select distinct lang, source from docs),
counts as (select w.lang, w.source, w.term, count(*) as n from words w join kept k on k.lang = w.lang and k.term = w.term group by all),
sizes as (select g.lang, g.source, l.v, l.n as lang_n, coalesce(sum(c.n), 0) as n from groups g join langs l on g.lang = l.lang left join counts c on c.lang = g.lang and c.source = g.source group by all),
shares as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n, {share("coalesce(c.n, 0)", "s.n")} as p, {share("k.n", "s.lang_n")} as q
  from sizes s join kept k on k.lang = s.lang left join counts c on c.lang = s.lang and c.source = s.source and c.term = k.term),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  where x.term is null or y.term is not null group by all),
terms as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from shares where n > 0 and p > q),
every_row as (select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms),
placed as (select *, row_number() over (partition by lang, source, part order by value desc, item) as place from every_row)
select lang, source, part, item, value::bigint as value, place::int as rank from placed where part = 'pair' or place <= {top}"""
