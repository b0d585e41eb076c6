import pytest
from pyspark.sql import functions as F

from tallyloom.operators import audit, changes, checks, datasets, hierarchy, keys, merge
from tallyloom.plans.publish import Store
from tallyloom.sources import csvs, relational
from tallyloom.specs import PublishSpec
from tallyloom.streaming.ticks import follow, tick

SPEC = PublishSpec("part", ("doc", "line"), ("doc",), ("doc", "line", "item"), ("amount",), not_zero=("item",))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def facts(spark, *values):
    return spark.createDataFrame(list(values), "part int, doc bigint, line int, item int, amount double")


def test_join_kinds():
    assert [datasets.join_kind(x) for x in ("LEFT OUTER JOIN", "right", None, "odd")] == ["left", "right", "inner", "inner"]


def test_upsert_keeps_and_orders(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, mark string")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (3, "c", 1), (None, "m", 1)], "k int, v string, seq int")
    assert rows(merge.upsert(target, source, ["k"], order=["seq"]), "k", "v", "mark") == sorted([(1, "new", "x"), (2, "b", "y"), (3, "c", None), (None, "n", "z"), (None, "m", None)], key=repr)
    assert rows(merge.upsert(target, source.select("k"), ["k"]), "k", "v") == sorted([(1, "a"), (2, "b"), (3, None), (None, "n"), (None, None)], key=repr)


def test_replace_empty_is_no_op(spark):
    target = spark.createDataFrame([(1, 5)], "k int, v int")
    assert rows(merge.replace(target, target.limit(0)), "k", "v") == [(1, 5)]
    assert rows(merge.replace(target, target.limit(0), "k = 1"), "k", "v") == [(1, 5)]
    with pytest.raises(ValueError):
        merge.load(target, target, "sideways")
    with pytest.raises(ValueError):
        merge.load(target, target, "upsert")


def test_delete_insert_null_key(spark):
    target = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    assert rows(merge.delete_insert(target, spark.createDataFrame([(1, 7), (None, 8)], "k int, v int"), ["k"]), "k", "v") == sorted([(1, 7), (2, 6), (None, 8)], key=repr)


def test_rollback_and_periods(spark):
    headers, lines = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1,), (3,)], "k int")
    h, li = merge.roll_back_incomplete(headers, lines, headers.where("k > 1"), "k")
    assert rows(h, "k") == [(1,), (3,)] and rows(li, "k") == [(1,)]
    have, new = spark.createDataFrame([("2024-01 ", 1)], "p string, v int"), spark.createDataFrame([("2024-01", 2), ("2024-02", 3)], "p string, v int")
    assert rows(merge.append_new_periods(have, new, "p"), "v") == [(1,), (3,)]
    assert rows(merge.stamp(have, "v", F.lit(9)), "v") == [(9,)]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_ids_never_change(spark, order):
    registry = spark.createDataFrame([], "guid string, id bigint")
    batches = [["c", "a"], ["b", "a"], ["d", "c", None]]
    seen: dict = {}
    for k in order:
        registry = keys.issue_ids(registry, spark.createDataFrame([(g,) for g in batches[k]], "guid string"), ["guid"])
        now = {r.guid: r.id for r in registry.collect()}
        assert all(now[g] == i for g, i in seen.items()) and sorted(now.values()) == list(range(1, len(now) + 1))
        seen = now
    assert set(seen) == {"a", "b", "c", "d"}


def test_links():
    assert keys.links_of(["raw_refs.shop", "raw_refs.order.uid", "raw_refs.order.type", "x"], ["dim_shop"], {"order": "orders"}) == {"shop": ("dim", "dim_shop"), "order": ("document", "orders")}
    with pytest.raises(ValueError):
        keys.links_of(["raw_refs.none"], [])
    assert keys.fk_column(["order_id"], "orders") == "order_id"


def test_hierarchy_with_cycle(spark):
    nodes = spark.createDataFrame([("r", None, "R"), ("a", "r", "A"), ("b", "a", "B"), ("x", "y", "X"), ("y", "x", "Y"), ("o", "gone", "O")], "guid string, parent_guid string, name string")
    flat = {r.id: (r.category, r.subcategory1) for r in hierarchy.flatten(nodes, 2).collect()}
    assert flat == {"r": (None, None), "a": ("R", None), "b": ("R", "A"), "x": ("Y", None), "y": ("X", None), "o": (None, None)}
    more = spark.createDataFrame([("gone", "top", "G"), ("top", None, "T")], nodes.schema)
    done = hierarchy.complete(nodes, lambda want: more.join(want, "guid", "left_semi"))
    assert hierarchy.missing_parents(done).isEmpty() and done.count() == 8


def test_classify(spark):
    c = spark.createDataFrame([("1",), ("2",), ("",), ("3",)], "uid string")
    assert rows(changes.classify(c, c.where("uid = '1'"), c.where("uid = '3'")), "uid", "state") == [("", "invalid"), ("1", "ready"), ("2", "pending"), ("3", "deleted")]


def test_schema_changes(spark):
    a, b = spark.createDataFrame([], "a int, b bigint, c string").schema, spark.createDataFrame([], "a bigint, b int, d string").schema
    assert checks.schema_changes(a, b) == [("a", "widened"), ("b", "narrowed"), ("c", "extra"), ("d", "missing")]
    assert checks.schema_changes(a, a) == []


def test_queue_wraps(spark):
    df = spark.range(1, 6)
    assert [r.id for r in audit.next_batch(df, "id", 3, 4).collect()] == [4, 5, 1, 2]


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    first = facts(spark, (1, 10, 1, 5, 2.0), (1, 11, 1, 6, 3.0), (2, 12, 1, 7, 4.0))
    assert store.publish(first, [1, 2]) == {1: "published", 2: "published"}
    assert store.publish(first, [1, 2]) == {1: "unchanged", 2: "unchanged"}
    changed = spark.createDataFrame([(10,), (12,)], "doc bigint")
    assert store.apply(changed, facts(spark, (2, 10, 1, 5, 9.0))) == {1: "published", 2: "published"}
    assert rows(store.current(), "part", "doc", "amount") == [(1, 11, 3.0), (2, 10, 9.0)]
    with pytest.raises(ValueError, match="checks"):
        store.publish(facts(spark, (1, 1, 1, 0, 1.0)), [1])
    with pytest.raises(ValueError, match="other partitions"):
        store.publish(first, [1])
    with pytest.raises(ValueError, match="empty"):
        store.publish(first.where("part = 2"), [1, 2])
    assert rows(store.current(), "part", "doc", "amount") == [(1, 11, 3.0), (2, 10, 9.0)]


def test_tick(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), SPEC)
    store.publish(facts(spark, (1, 10, 1, 5, 2.0), (1, 11, 1, 6, 3.0)), [1])
    source = facts(spark, (1, 10, 1, 5, 8.0), (1, 13, 1, 9, 1.0))
    signals = tmp_path / "signals"
    spark.createDataFrame([("10",), ("11",), ("99",)], "uid string").write.parquet(str(signals))
    run = tick(store, "doc", lambda ready: source.join(ready, source.doc.cast("string") == ready.uid, "left_semi"), lambda asked: source.select(F.col("doc").cast("string").alias("uid")), str(tmp_path / "pending"))
    follow(spark.readStream.schema("uid string").parquet(str(signals)), run, str(tmp_path / "ck")).awaitTermination()
    assert rows(store.current(), "doc", "amount") == [(10, 8.0)]
    assert rows(spark.read.parquet(str(tmp_path / "pending/0")), "uid") == [("99",)]


def test_csvs(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Period,SALES UNITS,City\n2024-01,7,Almaty\n2024-02,bad,\n")
    sales = csvs.sales_report(spark, str(tmp_path / "s.csv"), {"SALES UNITS": "units"}, ["units"], F.current_timestamp())
    assert rows(sales, "Period", "units", "City") == [("2024-01", 7.0, "Almaty"), ("2024-02", 0.0, "")]
    (tmp_path / "p.csv").write_text("ID;ZZZ;;\n1;2,5;a;b\n")
    assert rows(csvs.product_report(spark, str(tmp_path / "p.csv")), "ID", "ZZZ", "Segment11", "Segment12") == [("1", 2.5, "a", "b")]
    (tmp_path / "c.csv").write_text("Product,Max,,From,To\n 1 ,1 200,,01.02.2024,nan\n")
    import datetime

    assert rows(csvs.price_caps(spark, str(tmp_path / "c.csv")), "product_id", "max_asp", "start_date", "end_date") == [("1", 1200.0, datetime.date(2024, 2, 1), None)]
    (tmp_path / "u.csv").write_text("a,b\n x ,y\n")
    assert rows(csvs.user_sheet(spark, str(tmp_path / "u.csv"), ["email", "name"], F.current_timestamp()), "email", "name") == [("x", "y")]


def test_scans(spark):
    df = spark.createDataFrame([("0c0d0e0f-0a0b-0809-0001-020304050607", 1)], "k string, v int")
    assert relational.scan_key(df, "k", "0x0C0D0E0F0A0B08090001020304050607").count() == 1
    assert relational.scan_key(df, "k", "nonsense").count() == 0


def test_filter_reaches_scan(spark):
    plan = relational.scan(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), period="o_orderdate", start="1998-01-01").select("o_orderkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate" in plan
