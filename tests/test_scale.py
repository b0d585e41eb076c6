"""Ids, trees and stores beyond what one partition, or one small table, shows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.operators import checks, dimensions, hierarchy, integrity, keys, loads, merge, state
from tallyloom.plans.publish import Store, promote
from tallyloom.specs import PublishSpec
from tallyloom.streaming.ticks import classified, tick

SPEC = PublishSpec("part", ("doc", "line"), ("doc",), ("doc", "line", "item"), ("amount",))
FACTS = "part int, doc bigint, line int, item int, amount double"


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ids_are_one_to_n(spark, reuse):
    n = 400_000
    wide = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("guid"), F.concat(F.lit("name "), F.col("id")).alias("name"), F.lit("2024-02-01").cast("timestamp").alias("marked_at"))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        dim = spark.createDataFrame([], "guid string, id bigint, name string, is_stub boolean, marked_at timestamp")
        out = dimensions.incremental(dim, wide, "guid", ["name"], "marked_at")
        one = out.agg(F.count("*"), F.count_distinct("id"), F.min("id"), F.max("id")).first()
        assert tuple(one) == (n, n, 1, n)
        lag = out.selectExpr("id", "guid").orderBy("id").limit(1000).collect()
        assert [r.guid for r in lag] == sorted(r.guid for r in lag)
        registry = keys.issue_ids(spark.createDataFrame([], "guid string, id bigint"), wide, ["guid"])
        assert tuple(registry.agg(F.count_distinct("id"), F.max("id")).first()) == (n, n)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(st.sampled_from([*"abcdefgh", None]), max_size=6), min_size=1, max_size=3))
def test_ids_never_change_in_any_order(spark, batches):
    registry, seen = spark.createDataFrame([], "guid string, id bigint"), {}
    for batch in batches:
        registry = keys.issue_ids(registry, spark.createDataFrame([(g,) for g in batch], "guid string"), ["guid"])
        now = {r.guid: r.id for r in registry.collect()}
        assert all(now[g] == i for g, i in seen.items()) and sorted(now.values()) == list(range(1, len(now) + 1))
        seen = now
    assert set(seen) == {g for b in batches for g in b if g}


def test_a_million_nodes(spark):
    """Depth 6: node k hangs below k // 10."""
    n = 1_000_000
    nodes = spark.range(1, n).select(F.col("id").alias("guid"), F.when(F.col("id") >= 10, F.floor(F.col("id") / 10)).alias("parent_guid"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    flat = hierarchy.flatten(nodes, 6)
    one = flat.agg(F.count("*"), F.count("category"), F.count("subcategory4"), F.count("subcategory5")).first()
    assert tuple(one) == (n - 1, n - 10, n - 100_000, 0)
    r = flat.where("id = 345678").first()
    assert tuple(r)[1:] == ("n3", "n34", "n345", "n3456", "n34567", None)


def test_long_chain_and_cycle(spark):
    chain = [(k, k - 1 if k else None, f"n{k}") for k in range(150)]
    ring = [(1000 + k, 1000 + (k + 1) % 5, f"r{k}") for k in range(5)] + [(2000, 1000, "in"), (3000, 3000, "self")]
    nodes = spark.createDataFrame(chain + ring, "guid bigint, parent_guid bigint, name string")
    found = {(r.id, r.ancestor): r.distance for r in hierarchy.ancestors(nodes).collect()}
    assert all(found[(k, j)] == k - j for k in range(150) for j in range(k))
    assert {a: d for (i, a), d in found.items() if i == 2000} == {1000 + k: k + 1 for k in range(5)}
    assert {a: d for (i, a), d in found.items() if i == 1002} == {1003: 1, 1004: 2, 1000: 3, 1001: 4}
    assert not [1 for i, _ in found if i == 3000]


def test_store_refuses_rows_without_partition(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    with pytest.raises(ValueError, match="other partitions"):
        store.publish(spark.createDataFrame([(1, 1, 1, 1, 1.0), (None, 2, 1, 1, 1.0)], FACTS), [1])
    assert store.current() is None


def test_promotion(spark, tmp_path):
    shadow, live = (Store(spark, str(tmp_path / n), SPEC) for n in ("shadow", "live"))
    with pytest.raises(ValueError, match="empty"):
        promote(shadow, live)
    shadow.publish(spark.createDataFrame([(1, 1, 1, 1, 1.0), (2, 2, 1, 1, 2.0)], FACTS), [1, 2])
    assert promote(shadow, live) == "promoted" and promote(shadow, live) == "unchanged"
    shadow.publish(spark.createDataFrame([(1, 1, 1, 1, 9.0)], FACTS), [1])
    with pytest.raises(ValueError, match="other rows"):
        promote(shadow, live)
    other = Store(spark, str(tmp_path / "other"), SPEC)
    other.publish(spark.createDataFrame([(1, 1, 1, 1, 1.0, 5)], FACTS + ", more int"), [1])
    with pytest.raises(ValueError, match="columns"):
        promote(shadow, other)


def test_first_tick_and_ageing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    source = spark.createDataFrame([(1, 10, 1, 5, 8.0)], FACTS)
    run = tick(store, "doc", lambda ready: source.join(ready, source.doc.cast("string") == ready.uid, "left_semi"), lambda asked: source.select(F.col("doc").cast("string").alias("uid")), str(tmp_path / "pending"), now=lambda: F.lit("2024-01-20").cast("timestamp"))
    batch = lambda *rows: spark.createDataFrame(list(rows), "uid string, updated_at string")
    run(batch(("10", "2024-01-19"), ("77", "2024-01-19"), ("78", "2024-01-01")), 0)
    assert [r.doc for r in store.current().collect()] == [10]
    assert [r.uid for r in spark.read.parquet(str(tmp_path / "pending/0")).collect()] == ["77"]
    run(batch(("79", "2024-01-20")), 1)
    assert sorted(r.uid for r in spark.read.parquet(str(tmp_path / "pending/1")).collect()) == ["77", "79"]
    asked = spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-01"), ("3", "2024-01-19"), ("", "2024-01-19"), ("4", "2024-01-01")], "uid string, since string").withColumn("since", F.col("since").cast("timestamp"))
    keys_ = lambda *k: spark.createDataFrame([(x,) for x in k], "uid string")
    got = {r.uid: r.state for r in classified(asked, keys_("1"), keys_("4"), F.lit("2024-01-20").cast("timestamp")).collect()}
    assert got == {"1": "ready", "2": "aged", "3": "pending", "": "invalid", "4": "deleted"}


def test_findings_raise_together(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    with pytest.raises(ValueError, match=r"null:t.v = 1; twice:t = 1"):
        integrity.require(integrity.load_suite({"t": df}, {"t": ["k"]}, {"t": ["v"]}, {}))
    integrity.require(integrity.load_suite({"t": df.where("v = 2")}, {"t": ["k"]}, {"t": ["v"]}, {}))
    with pytest.raises(ValueError, match="lacks the key"):
        integrity.members_alike([(df, {}, {}, {})], ["k"], [], [], "k")


def test_groups_fail_together():
    done = []
    with pytest.raises(ExceptionGroup) as error:
        state.isolated({"a": lambda: 1 / 0, "b": lambda: done.append(1), "c": lambda: int("x")})
    assert done == [1] and len(error.value.exceptions) == 2


def test_rebuild_retries_the_race_alone(spark):
    nothing, calls = spark.createDataFrame([], "check string, bad long"), []

    def racing():
        calls.append(1)
        if len(calls) < 2:
            raise BlockingIOError
        return "done"

    assert loads.rebuild(racing, lambda: nothing, lambda: nothing) == "done" and len(calls) == 2
    with pytest.raises(ZeroDivisionError):
        loads.rebuild(lambda: 1 / 0, lambda: nothing, lambda: nothing)
    with pytest.raises(ValueError, match="reconcile"):
        loads.rebuild(lambda: 1, lambda: nothing, lambda: spark.createDataFrame([("x", 1)], "check string, bad long"))


def test_loads_take_an_order(spark):
    target, source = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "x", 1), (1, "b", 2), (2, "y", 1), (2, "c", 2)], "k int, v string, seq int")
    found = lambda df: sorted((r.k, r.v) for r in df.collect())
    assert found(merge.load(target, source, "upsert", ["k"], order=["seq"])) == [(1, "b"), (2, "c")]
    assert found(merge.insert_missing(target, source, ["k"], order=["seq"])) == [(1, "a"), (2, "y")]
    assert found(merge.update_if_different(target, source, "k", ["v"], order=["seq"])) == [(1, "b")]


def test_jdbc_bounds(spark, monkeypatch):
    """Without bounds the least and the largest value are asked for first."""
    from tallyloom.sources import relational

    asked = []

    class Reader:
        def format(self, _):
            return self

        def options(self, **kw):
            asked.append(kw)
            return self

        def option(self, name, value):
            asked.append({name: value})
            return self

        def load(self):
            return spark.createDataFrame([(3, 99)], "low int, high int")

    class Session:
        read = Reader()

    relational.read_jdbc(Session(), "jdbc:x", "select * from t", split_on="id")
    assert asked[-1]["lowerBound"] == 3 and asked[-1]["upperBound"] == 99 and asked[-1]["partitionColumn"] == "id"
    relational.read_jdbc(Session(), "jdbc:x", "select 1")
    assert asked[-1] == {"query": "select 1"}


def test_jdbc_reads_a_database(spark):
    """A database in this process: a query whole, and split in ranges between bounds that are asked for."""
    from tallyloom.sources import relational

    url, driver = "jdbc:derby:memory:tallyloom;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    spark.range(1, 1001).select(F.col("id").alias("ID"), (F.col("id") * 2).alias("TWICE")).write.format("jdbc").options(url=url, driver=driver, dbtable="facts").mode("overwrite").save()
    whole = relational.read_jdbc(spark, url, "select * from facts", driver=driver)
    split = relational.read_jdbc(spark, url, "select * from facts where id <= 600", split_on="ID", parts=4, driver=driver)
    assert whole.agg(F.sum("TWICE")).first()[0] == 1001 * 1000 and split.rdd.getNumPartitions() == 4
    assert sorted(r.ID for r in split.collect()) == list(range(1, 601))
    none = relational.read_jdbc(spark, url, "select * from facts where id < 0", split_on="ID", parts=4, driver=driver)
    assert none.count() == 0


@pytest.mark.parametrize("split_on", ["ID", "NAME"])
def test_jdbc_reads_even_ranges(spark, split_on):
    """Keys crowded at one end, a null key, and a text key: every task reads about its share."""
    from tallyloom.sources import relational

    url, driver = "jdbc:derby:memory:even;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    key = F.when(F.col("id") < 9000, F.col("id")).when(F.col("id") < 9999, F.col("id") * 100_000)
    rows = spark.range(10_000).select(key.alias("ID"), F.concat(F.lit("it's "), F.lpad(F.coalesce(key, F.lit(0)).cast("string"), 12, "0")).alias("NAME"))
    rows.write.format("jdbc").options(url=url, driver=driver, dbtable="crowded", createTableColumnTypes="NAME VARCHAR(40)").mode("overwrite").save()
    got = relational.read_even(spark, url, "select * from crowded", split_on, parts=8, driver=driver)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 8 and max(sizes) <= 2 * 10_000 / 8
    assert got.select("ID").distinct().count() == 10_000
    assert relational.read_even(spark, url, "select * from crowded where id < 0", split_on, driver=driver).count() == 0


def test_even_bounds(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    from tallyloom.sources.relational import even_bounds

    assert even_bounds(keys(), 4) == [] == even_bounds(keys(None, 5), 4)
    assert even_bounds(keys(*range(100)), 4) == [25, 50, 75]
    assert even_bounds(keys(*[7] * 90, *range(10, 20)), 4) == [] and even_bounds(keys(*range(5), *[7] * 90), 4) == [7]


def test_schema_checks(spark):
    assert checks.schema_changes(spark.range(1).schema, spark.range(1).schema) == []
