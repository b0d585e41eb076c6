"""An id that many rows share, null among them, is numbered and mixed in parts."""

from collections import Counter

from pyspark.sql import functions as F

from tallyloom.llm import source_mix


def test_many_rows_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "PART", 100)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, "w " * (k % 13), f"s{k % 4}" if k % 5 else None) for k in range(1500)] + [(None, "the same", "s1")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    sized = docs.select(F.col("doc_id").alias("d"), "source", source_mix.word_count("text").alias("size"), source_mix.content_hash(docs).alias("h"))
    got, seen = sorted(sized.collect(), key=lambda r: (r.d is not None, r.d or 0, r["size"], r.source is None, r.source or "", r.h)), Counter()
    want = Counter()
    for r in got:
        seen[r.d] += 1
        want[(*r, seen[r.d])] += 1
    assert Counter(map(tuple, source_mix.numbered(sized).collect())) == want
    plan = source_mix.mix_plan(docs).agg(F.sum("copies"), F.sum(F.col("copies") * F.col("size"))).first()
    mixed = source_mix.mix(docs)
    assert (mixed.count(), mixed.agg(F.sum(source_mix.word_count("text"))).first()[0]) == tuple(plan)
    taken = Counter(map(tuple, mixed.collect()))
    assert all(0 < n <= 2 * Counter(rows)[r] for r, n in taken.items())
    physical = mixed._jdf.queryExecution().executedPlan().toString()
    assert "map_from_entries" not in physical and "collect_list(struct(occ" not in physical


def test_names_with_dots(spark):
    rows = [(k, f"{'word ' * (k % 5)}", f"s{k % 3}") for k in range(60)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    dotted = plain.toDF("the.id", "the.text", "the.source")
    names = {"id_col": "the.id", "text": "the.text", "source": "the.source"}
    once = lambda df, **kw: sorted(tuple(r) for r in source_mix.mix(df, **kw).collect())
    assert {r[0] for r in once(dotted, **names)} <= set(range(60)) and len(once(dotted, **names)) > 20
    plan = source_mix.mix_plan(dotted, **names)
    assert plan.columns[0] == "the.id" and plan.count() == 60
