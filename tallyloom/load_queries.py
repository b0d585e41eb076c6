"""More registered queries: scans, loads, publishing, ticks, integrity, journals, each beside its DuckDB SQL.

Built over the same tables and helpers as ``tallyloom.queries``, which imports this module.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import functions as F

from tallyloom.functions import scalars as S
from tallyloom.operators import audit, changes, checks, datasets, dimensions, fingerprint, hierarchy, integrity, keys, loads, merge, state
from tallyloom.plans import publish
from tallyloom.plans.buckets import BucketTable, Registry
from tallyloom.queries import _BASE, _DIM, _FP, _LI, _PART, _RUNS, _SIG, CUT, SPEC, base, dim_frames, double, kind, lines, money, parted, query, runs, signalled, t, uuid_of, uuid_sql
from tallyloom.sources import csvs, relational
from tallyloom.sources.signal_stream import SignalSource
from tallyloom.specs import ColumnSpec, PublishSpec, TargetSpec
from tallyloom.staged import scratch
from tallyloom.streaming import ticks


def ts(text: str):
    return F.lit(text).cast("timestamp")


# ---- scans and filters


@query(f"select c_custkey, c_name from customer where {uuid_sql('c_custkey')} = {uuid_sql('17')}")
def one_key_scan(spark, sf):
    """SRC-03: one reference, written in another way than it is stored"""
    rows = t(spark, sf, "customer").withColumn("guid", uuid_of(F.col("c_custkey")))
    asked = "0x" + "70EFDF2EC9B086079795C442636B55FB"  # MD5 of 17
    return relational.scan_key(rows, "guid", asked).select("c_custkey", "c_name")


@query("select o_orderkey as doc, 'header' as part, count(*) as n, sum(o_totalprice) as amount from orders where o_orderkey = (select max(o_orderkey) from orders) group by 1 union all select l_orderkey, 'lines', count(*), sum(l_extendedprice) from lineitem where l_orderkey = (select max(o_orderkey) from orders) group by 1")
def one_document(spark, sf):
    """SRC-04: the newest document's header and lines"""
    orders = t(spark, sf, "orders")
    header, details = relational.document(orders.withColumnRenamed("o_orderkey", "doc"), {"lines": t(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "doc")}, "doc", orders.agg(F.max("o_orderkey")).first()[0])
    total = lambda df, part, amount: df.groupBy("doc").agg(F.lit(part).alias("part"), F.count("*").alias("n"), F.sum(amount).alias("amount"))
    return total(header, "header", "o_totalprice").union(total(details["lines"], "lines", "l_extendedprice"))


@query(f"select o_orderkey as doc, o_totalprice * 2 as twice from orders where {_PART} = 199703")
def one_partition(spark, sf):
    """SRC-05"""
    return relational.partition_of(parted(spark, sf), {"doc": "o_orderkey", "twice": "o_totalprice * 2"}, "part", 199703)


@query(f"select {uuid_sql('c_custkey')} as guid, trim(c_name) as name, timestamp '2024-01-01' + interval 6 hour as changed_at from customer where c_custkey % 7 <> 0 and c_custkey % 5 <> 0")
def live_references(spark, sf):
    """SRC-16, FLT-07, FLT-08: neither deleted nor of an invalid guid"""
    k = F.col("c_custkey")
    feed = t(spark, sf, "customer").select(F.when(k % 5 == 0, F.lit("none")).otherwise(F.concat(F.lit(" "), F.upper(uuid_of(k)))).alias("guid"), F.concat(F.col("c_name"), F.lit("  ")).alias("title"), F.when(k % 7 == 0, ts("2024-01-02")).alias("deleted_at"), ts("2024-01-01").alias("changed_at"))
    return relational.live_products(feed, "guid", {"name": "title"}, "changed_at")


@query("select event_id, ts, user_id from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'")
def day_rows(spark, sf):
    """SRC-17"""
    return relational.of_day(t(spark, sf, "events"), "ts", "2024-01-10").select("event_id", "ts", "user_id")


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def listed_references(spark, sf):
    """SRC-15"""
    wanted = t(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.of_guids(t(spark, sf, "customer").select("c_custkey", "c_name"), wanted, "c_custkey")


@query("select c_custkey as guid, row_number() over (order by c_custkey) as id, c_name as name, false as is_stub from customer where c_custkey <> 1")
def full_reference_load(spark, sf):
    """SRC-14: an empty dimension from the whole reference, without the empty one"""
    empty = spark.createDataFrame([], "guid string, id bigint, name string, is_stub boolean")
    source = t(spark, sf, "customer").select(F.format_string("%012d", "c_custkey").alias("guid"), F.col("c_name").alias("name"))
    out = dimensions.full_load(empty, source, "guid", ["name"], f"{1:012d}")
    return out.withColumn("guid", F.col("guid").cast("bigint"))


@query("select o_orderkey from orders where o_orderstatus <> 'P' and coalesce(o_custkey % 4 <> 0, true)")
def posted_documents(spark, sf):
    """FLT-05"""
    rows = t(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") != "P").alias("is_posted"), F.when(F.col("o_custkey") % 4 == 0, True).alias("is_deleted"))
    return datasets.posted(rows).select("o_orderkey")


_WIN = "o_orderdate >= timestamp '1996-01-01' and o_orderdate <= timestamp '1996-03-01'"


@query(f"with h as (select o_orderkey, {_PART} as part from orders where {_WIN}), k as (select * from h where part in (199601, 199602)) select (select count(*) from k) as n_headers, (select count(*) from lineitem where l_orderkey in (select o_orderkey from k)) as n_lines, (select count(*) from h) - (select count(*) from k) as dropped")
def inside_partitions(spark, sf):
    """FLT-09: a window with both ends brings documents of the next month's first midnight"""
    h = datasets.in_period(parted(spark, sf), "o_orderdate", "1996-01-01", "1996-03-01").select("o_orderkey", "part")
    li = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    kept, li, dropped = datasets.inside_parts(h, li, "o_orderkey", F.col("part"), [199601, 199602])
    return kept.agg(F.count("*").alias("n_headers")).join(li.agg(F.count("*").alias("n_lines"))).join(dropped)


@query("select o_orderkey, min(w)::int as window_no from (select o_orderkey, unnest([1, 2]) as w, o_orderdate from orders) where (w = 1 and o_orderdate <= timestamp '1997-01-01') or (w = 2 and o_orderdate >= timestamp '1996-12-31') group by 1")
def first_windows(spark, sf):
    """FLT-10: a document that two adjacent windows bring counts in the first"""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    one = datasets.in_period(orders, "o_orderdate", None, "1997-01-01").withColumn("window_no", F.lit(1))
    two = datasets.in_period(orders, "o_orderdate", "1996-12-31").withColumn("window_no", F.lit(2))
    return datasets.first_window(one.union(two), "o_orderkey", "window_no").select("o_orderkey", "window_no")


@query(f"with {_SIG} select uid, updated_at, least(timestamp '2024-01-31', timestamp '2024-01-30 06:00:00') as window_end from sig where updated_at < timestamp '2024-01-30 06:00:00'")
def clamped_signals(spark, sf):
    """FLT-11"""
    kept, end = changes.clamp(signalled(spark, sf), ts("2024-01-31"), ts("2024-01-30 06:00:00"))
    return kept.withColumn("window_end", end)


@query(f"select {_PART} as part, count(*) as n from orders where {_PART} >= 199706 group by 1")
def after_history(spark, sf):
    """FLT-12"""
    return integrity.since_history(parted(spark, sf), "part", 199706).groupBy("part").agg(F.count("*").alias("n"))


@query("select o_orderkey, case when o_orderstatus = 'F' then o_custkey end as partner from orders")
def typed_reference(spark, sf):
    """FLT-13"""
    return t(spark, sf, "orders").select("o_orderkey", S.ref_if(F.col("o_custkey"), kind(), 476).alias("partner"))


# ---- projections


@query("select o_orderkey as doc, upper(o_orderstatus) as status, o_totalprice / 2 as half from orders")
def projected_columns(spark, sf):
    """PRJ-01"""
    return datasets.project(t(spark, sf, "orders"), (ColumnSpec("doc", "o_orderkey"), ColumnSpec("status", "o_orderstatus", transform=F.upper), ColumnSpec("half", expression="o_totalprice / 2")))


@query("select o_orderkey as doc, lower(o_orderpriority) as priority from orders")
def legacy_mapping(spark, sf):
    """PRJ-05: mapped columns that exist"""
    return datasets.map_legacy(t(spark, sf, "orders"), {"o_orderkey": "doc", "o_orderpriority": "priority", "no_such": "x"}, {"o_orderpriority": F.lower, "no_such": F.upper})


@query(f"with {_LI} select (select count(*) from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from li)) as n_rows, (select count(distinct l_orderkey) from li) as n_keys, (select sum(length('{{\"part\":\"' || l_partkey || '\"}}'))::bigint from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from li)) as refs_length")
def extracted_frame(spark, sf):
    """PRJ-06, PIP-04: rows with packed references, their number, and the keys that came back"""
    rows, n, got = datasets.frame_of(lines(spark, sf), (), {"part": "l_partkey"}, TargetSpec("lines", keys=("l_orderkey", "l_linenumber"), include=("l_partkey", "l_suppkey")), ["l_linenumber"], "l_orderkey")
    return n.withColumnRenamed("n", "n_rows").join(got.agg(F.count("*").alias("n_keys"))).join(rows.agg(F.sum(F.length("raw_refs")).alias("refs_length")))


@query(f"with {_SIG}, rows as (select o_orderkey, timestamp '2024-02-01' as etl_updated_at, updated_at as retail_updated_at from orders left join sig on uid = o_orderkey::varchar) select *, (select max(retail_updated_at) from rows) as retail_snapshot_at from rows")
def stamped_rows(spark, sf):
    """PRJ-10: a mark by key, one snapshot mark for the run"""
    return loads.audit_stamps(t(spark, sf, "orders").select("o_orderkey"), "o_orderkey", ts("2024-02-01"), signalled(spark, sf))


@query("select o_orderkey, o_orderdate as period, substr(h,25,8)||'-'||substr(h,21,4)||'-'||substr(h,17,4)||'-'||substr(h,1,4)||'-'||substr(h,5,12) as recorder, '0x' || upper(h) as kept_hex from (select *, md5(o_orderkey::varchar) as h from orders)")
def auto_decoded(spark, sf):
    """PIP-05, PIP-06, SCL-36: binary by length and shifted dates, without a configured transform"""
    rows = t(spark, sf, "orders").select("o_orderkey", F.add_months("o_orderdate", 24000).cast("timestamp").alias("period"), F.unhex(F.md5(F.col("o_orderkey").cast("string"))).alias("recorder"))
    out = datasets.auto_transforms(datasets.with_raw(rows))
    return out.select("o_orderkey", "period", "recorder", F.get_json_object("raw_hex", "$.recorder").alias("kept_hex"))


@query("select o_orderkey, upper(o_orderpriority) as o_orderpriority, o_totalprice * 0.12 as vat, timestamp '2024-02-01' as etl_loaded_at from orders")
def computed_columns(spark, sf):
    """UDF-01: transforms, computed columns whose inputs exist, the load stamp"""
    out = datasets.apply_transforms(t(spark, sf, "orders"), (ColumnSpec("o_orderpriority", transform=F.upper),), {"vat": (("o_totalprice",), F.col("o_totalprice") * 0.12)}, ts("2024-02-01"))
    return out.select("o_orderkey", "o_orderpriority", "vat", "etl_loaded_at")


# ---- loads and publishing


@query(f"with {_BASE} select * from base union all select o_orderkey, o_custkey, o_orderstatus, null from orders where o_orderdate >= timestamp '{CUT}'")
def appended_rows(spark, sf):
    """SNK-01"""
    return merge.append(base(spark, sf), t(spark, sf, "orders").where(F.col("o_orderdate") >= CUT).select("o_orderkey", "o_custkey", "o_orderstatus"))


@query(f"with {_BASE}, src as (select o_orderkey, o_custkey, 'N' as o_orderstatus, 1.0 as o_totalprice from orders where o_custkey % 3 = 0), b as (select 'base' as w, * from base), met as (select b.o_orderkey as k, s.o_orderkey as s from base b full join src s using (o_orderkey)) select 'insert' as mode, (select count(*) from base) + (select count(*) from src) as n, (select count(*) from src) as n_new union all select 'upsert', (select count(*) from met), (select count(*) from src) union all select 'replace', (select count(*) from src), (select count(*) from src) union all select 'delete_insert', (select count(*) from met), (select count(*) from src)")
def load_modes(spark, sf):
    """SNK-06: every mode"""
    target, source = base(spark, sf), t(spark, sf, "orders").where("o_custkey % 3 = 0").select("o_orderkey", "o_custkey", F.lit("N").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    counted = [merge.load(target, source, m, ["o_orderkey"]).agg(F.lit(m).alias("mode"), F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "N").alias("n_new")) for m in ("insert", "upsert", "replace", "delete_insert")]
    return integrity.together(counted)


@query(f"with {_LI} select l_suppkey as k, max(l_shipdate) as at from li group by 1")
def upsert_without_order(spark, sf):
    """SNK-03, SNK-06: of several rows of a key a load takes the largest, so a rerun takes the same"""
    target = t(spark, sf, "supplier").limit(0).select(F.col("s_suppkey").alias("k"), F.lit(None).cast("timestamp").alias("at"))
    return merge.load(target, lines(spark, sf).select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").cast("timestamp").alias("at")), "upsert", ["k"])


@query("select c_custkey, timestamp '2024-03-01' as marked from customer")
def one_mark(spark, sf):
    """SNK-12, STR-19"""
    rows = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, ts("2024-03-01")).when(F.col("c_custkey") % 3 == 0, ts("2023-03-01")).alias("marked"))
    return merge.stamp(rows, "marked", ts("2024-03-01"))


@query(f"select {_PART}::varchar as p, count(*) as n, sum((o_orderdate < timestamp '1997-01-01')::int)::bigint as n_old from orders group by 1")
def new_periods(spark, sf):
    """SNK-14: only periods the target has not yet"""
    rows = parted(spark, sf).select(F.col("part").cast("string").alias("p"), (F.col("o_orderdate") < "1997-01-01").cast("int").alias("old"))
    target = rows.where("old = 1").withColumn("p", F.concat("p", F.lit(" ")))
    out = merge.append_new_periods(target, rows, "p")
    return out.groupBy(F.trim("p").alias("p")).agg(F.count("*").alias("n"), F.sum("old").cast("bigint").alias("n_old"))


@query("with run as (select o_orderkey as k from orders where o_orderstatus = 'P'), bare as (select k from run where k not in (select l_orderkey from lineitem)) select (select count(*) from orders where o_orderkey not in (select k from bare)) as n_headers, (select count(*) from lineitem where l_orderkey not in (select k from run)) as n_lines")
def rolled_back_run(spark, sf):
    """SNK-18"""
    h, li = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus"), t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    h, li = merge.roll_back_incomplete(h, li, h.where("o_orderstatus = 'P'").select("k"), "k")
    return h.agg(F.count("*").alias("n_headers")).join(li.agg(F.count("*").alias("n_lines")))


@query("select o_custkey as id, arg_max(o_orderstatus, o_orderkey) as zzz, null::varchar as note from orders group by 1")
def product_feed(spark, sf):
    """SNK-15, WIN-04: the last row of a key in file order, columns the target knows"""
    target = t(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("zzz"), F.lit("old").alias("note"))
    rows = t(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("zzz"), F.col("o_orderkey").alias("file_row"), F.lit(1).alias("unknown"))
    return loads.feed(target, rows, ["id"], ["file_row"])


FACTS = PublishSpec("part", ("o_orderkey",), ("o_orderkey",), ("o_orderkey", "o_custkey"), ("o_totalprice",), on_empty="clear")


def published(spark, sf, rows, name):
    store = publish.Store(spark, scratch(spark, name), FACTS)
    store.publish(rows, sorted(r[0] for r in rows.select("part").distinct().collect()))  # a row a month
    return store


def facts(spark, sf):
    return parted(spark, sf).select("part", "o_orderkey", "o_custkey", "o_totalprice")


@query(f"select {_PART} as part, o_orderkey, o_custkey, o_totalprice + case when {_PART} = 199702 then 1 else 0 end as o_totalprice from orders where {_PART} <> 199701")
def publish_rebuild(spark, sf):
    """SNK-07, STR-12, STR-13, STR-14: one month rebuilt, an equal one left, an emptied one cleared"""
    rows = facts(spark, sf)
    store = published(spark, sf, rows, "published")
    again = rows.where("part in (199702, 199703)").withColumn("o_totalprice", F.col("o_totalprice") + (F.col("part") == 199702).cast("int"))
    done = store.publish(again, [199701, 199702, 199703])
    if list(done.values()) != ["cleared", "published", "unchanged"] and rows.where("part in (199701, 199702, 199703)").select("part").distinct().count() == 3:
        raise ValueError(f"published {done}")
    return store.current()


@query(f"select {_PART} as part, o_orderkey, o_custkey, o_totalprice from orders")
def promoted_table(spark, sf):
    """SNK-19: a shadow table made live, twice"""
    shadow = published(spark, sf, facts(spark, sf), "shadow")
    live = publish.Store(spark, scratch(spark, "live"), FACTS)
    if (publish.promote(shadow, live), publish.promote(shadow, live)) != ("promoted", "unchanged"):
        raise ValueError("promotion did not settle")
    return live.current()


@query(f"select distinct {_PART} as part from orders where o_orderkey % 500 = 3")
def swept_partitions(spark, sf):
    """STR-09: partitions whose fingerprint differs from the source's"""
    rows = facts(spark, sf)
    store = published(spark, sf, rows, "swept")
    source = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 500 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return store.sweep(source)


@query(f"with {_BASE}, fresh as (select o_orderkey, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 5 = 0), loaded as (select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey, o_custkey, coalesce(f.o_totalprice, b.o_totalprice) as o_totalprice from base b full join fresh f on b.o_orderkey = f.o_orderkey) select c_nationkey, count(*) as n, sum(o_totalprice::decimal(18,4))::double as amount from loaded join customer on o_custkey = c_custkey group by 1")
def sql_after_load(spark, sf):
    """UDF-03: a user's SQL over the tables that a load has left"""
    loaded = merge.load(base(spark, sf), t(spark, sf, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")), "upsert", ["o_orderkey"])
    sql = "select c_nationkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as amount from {facts} join {dims} on o_custkey = c_custkey group by 1"
    return datasets.after_load(spark, sql, facts=loaded, dims=t(spark, sf, "customer"))


@query(f"with {_SIG} select uid, updated_at from sig order by updated_at desc, uid limit 100")
def newest_signals(spark, sf):
    """SRT-02, SRT-03: the newest change signals"""
    return changes.newest(signalled(spark, sf), 100)


@query(f"with {_BASE}, fresh as (select o_orderkey, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 5 = 0) select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey, o_custkey, o_orderstatus, coalesce(f.o_totalprice, b.o_totalprice) as o_totalprice from base b full join fresh f on b.o_orderkey = f.o_orderkey")
def bucketed_upsert(spark, sf):
    """SNK-02, SNK-03: as a load of the touched buckets of a keyed table"""
    table = BucketTable(spark, scratch(spark, "keyed"), ["o_orderkey"])
    table.upsert(base(spark, sf))
    table.upsert(t(spark, sf, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")))
    return table.read().select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(f"with old as (select g, row_number() over (order by g) as id from (select distinct {uuid_sql('o_custkey')} as g from orders where o_orderdate < timestamp '{CUT}')), fresh as (select distinct {uuid_sql('o_custkey')} as g from orders except select g from old) select g as guid, id from old union all select g, row_number() over (order by g) + (select max(id) from old) from fresh")
def bucketed_registry(spark, sf):
    """KEY-01, KEY-02: ids issued by buckets, the second batch known in part"""
    registry = Registry(spark, scratch(spark, "registry"), ["guid"])
    orders = t(spark, sf, "orders").withColumn("guid", uuid_of(F.col("o_custkey")))
    registry.issue(orders.where(F.col("o_orderdate") < CUT))
    registry.issue(orders)
    return registry.read()


@query(f"select {_PART} as part, o_orderkey, case o_orderkey % 3 when 0 then 'changed' when 1 then 'deleted' else 'new' end as state from orders where o_orderkey % 500 between 3 and 5")
def swept_by_tree(spark, sf):
    """STR-09, CHK-05, CHK-06: documents that differ, over all orders; of the store only its tree is read"""
    rows, k = facts(spark, sf), F.col("o_orderkey")
    odd = (k % 500).between(3, 5)
    store = published(spark, sf, rows.where(~odd | (k % 3 != 2)), "tree")
    return store.differing_documents(rows.where(~odd | (k % 3 != 1)).withColumn("o_totalprice", F.col("o_totalprice") + (odd & (k % 3 == 0)).cast("int")))


@query(f"select {_PART} as part, count(*) as n, sum((o_totalprice * case when {_PART} in (199701, 199801) then 2 else 1 end)::decimal(18,4))::double as amount from orders group by 1")
def concurrent_publishers(spark, sf):
    """SNK-07, STR-12: of publishers that start from one version those of other partitions land, and of one partition's one does"""
    rows = facts(spark, sf)
    store = published(spark, sf, rows, "shared")
    at = store.snapshot()
    month = lambda p, times: rows.where(F.col("part") == p).withColumn("o_totalprice", F.col("o_totalprice") * times)
    for p in (199701, 199801):
        publish.Store(spark, store.path, FACTS).publish(month(p, 2), [p], base=at)
    try:
        store.publish(month(199701, 3), [199701], base=at)
    except publish.ConflictError:
        return store.current().groupBy("part").agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("amount"))
    raise ValueError("a lost update")


@query(f"select {_PART} as part, count(*) as n, sum(o_totalprice::decimal(18,4))::double as amount from orders group by 1")
def published_snapshot(spark, sf):
    """STR-12, STR-13: a snapshot gives the rows of its version, whatever is published after it"""
    rows = facts(spark, sf)
    store = published(spark, sf, rows, "kept")
    at = store.snapshot()
    store.apply(rows.select("o_orderkey").where("o_orderkey % 4 = 0"), rows.where("o_orderkey % 8 = 0").withColumn("o_totalprice", F.lit(1.0)))
    if store.snapshot().version == at.version:
        raise ValueError("nothing was published")
    return store.current(at=at).groupBy("part").agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("amount"))


@query(f"select {_PART} as part, count(*) as n from orders where {_PART} in (199612, 199701) group by 1")
def hot_window(spark, sf):
    """STR-08, SCL-29: the current month and the one before"""
    return parted(spark, sf).where(F.array_contains(S.hot_months(ts("1997-01-15 10:00:00")), F.col("part"))).groupBy("part").agg(F.count("*").alias("n"))


@query(f"with {_BASE}, load as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate between timestamp '1997-06-01' and timestamp '1998-06-30') select coalesce(l.o_orderkey, b.o_orderkey) as o_orderkey, coalesce(l.o_totalprice, b.o_totalprice) as o_totalprice, case when l.o_orderkey is not null then timestamp '2024-02-01' end as retail_snapshot_at from base b full join load l on b.o_orderkey = l.o_orderkey")
def full_period_load(spark, sf):
    """STR-04, CHK-01: a period's rows under one snapshot stamp, validated"""
    target = base(spark, sf).withColumns({"retail_snapshot_at": F.lit(None).cast("timestamp"), "etl_updated_at": ts("2024-01-01")})
    rows = datasets.in_period(t(spark, sf, "orders"), "o_orderdate", "1997-06-01", "1998-06-30").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    suite = lambda out: integrity.load_suite(out, {"orders": ["o_orderkey"]}, {"orders": ["o_custkey"]}, {})
    out = loads.full_period({"orders": target}, {"orders": rows}, {"orders": TargetSpec("orders", keys=("o_orderkey",))}, "o_orderkey", ts("2024-02-01"), ts("2024-02-02"), suite)
    return out["orders"].select("o_orderkey", "o_totalprice", "retail_snapshot_at")


@query(f"with {_BASE} select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey, coalesce(f.o_totalprice, b.o_totalprice) as o_totalprice, case when b.o_orderkey is not null then timestamp '2024-01-01' end as retail_updated_at from base b full join (select o_orderkey, o_totalprice + 5 as o_totalprice from orders where o_orderstatus = 'P') f on b.o_orderkey = f.o_orderkey")
def reloaded_documents(spark, sf):
    """STR-06: listed documents read again; marks, and with them the watermark, stay"""
    target = base(spark, sf).select("o_orderkey", "o_totalprice").withColumns({"retail_updated_at": ts("2024-01-01"), "etl_updated_at": ts("2024-01-01")})
    rows = t(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") + 5).alias("o_totalprice"))
    asked = t(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_orderkey")
    out = loads.documents({"orders": target}, {"orders": rows}, {"orders": TargetSpec("orders", keys=("o_orderkey",))}, asked, "o_orderkey", ts("2024-02-02"))
    return out["orders"].select("o_orderkey", "o_totalprice", "retail_updated_at")


# ---- ticks


@query("select user_id::varchar as uid, max(ts) as updated_at, count(distinct event_type) as n_sources from events where event_type in ('purchase', 'click', 'view') group by 1")
def streamed_signals(spark, sf):
    """SRC-12, STR-01: three sources as one stream with an offset each; the latest signal of each key"""
    spark.dataSource.register(SignalSource)
    tables = [{"path": f"{sf}/events.parquet", "key": "user_id", "at": "ts", "where": ["event_type", x], "name": x} for x in ("purchase", "click", "view")]
    signals = spark.readStream.format("change_signals").option("tables", json.dumps(tables)).load()
    out, home = scratch(spark, "signals"), scratch(spark, "signals-checkpoint")
    signals.writeStream.format("parquet").option("path", out).option("checkpointLocation", home).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("uid string, updated_at timestamp, source string").parquet(out)
    return rows.groupBy("uid").agg(F.max(F.timestamp_add("MICROSECOND", F.unix_micros("updated_at"), F.lit("1970-01-01").cast("timestamp_ntz"))).alias("updated_at"), F.count_distinct("source").alias("n_sources"))


@query(f"with {_SIG} select * from sig where updated_at >= timestamp '2024-01-28' - interval 5 minute and updated_at < timestamp '2024-01-31' - interval 5 second")
def tick_window(spark, sf):
    """STR-01"""
    return ticks.in_bounds(signalled(spark, sf), ts("2024-01-28"), ts("2024-01-31"))


_AGED = "(select uid, min(updated_at) as since from (select (user_id * 101 % 20000)::varchar as uid, ts as updated_at from events where event_type in ('purchase', 'click')) group by 1)"


@query(f"select uid, case when uid in (select o_orderkey::varchar from orders where o_orderdate >= timestamp '{CUT}') then 'ready' when uid in (select o_orderkey::varchar from orders) then 'deleted' when since < timestamp '2024-01-17' - interval 15 day then 'aged' else 'pending' end as state from {_AGED}")
def pending_aged(spark, sf):
    """STR-02, STR-03: what neither side has waits, and ages out after the look-back"""
    ev = t(spark, sf, "events").where("event_type in ('purchase', 'click')")
    asked = ev.groupBy((F.col("user_id") * 101 % 20000).cast("string").alias("uid")).agg(F.min("ts").cast("timestamp").alias("since"))
    ids = t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("uid"), "o_orderdate")
    return ticks.classified(asked, ids.where(F.col("o_orderdate") >= CUT).select("uid"), ids.where(F.col("o_orderdate") < CUT).select("uid"), ts("2024-01-17")).select("uid", "state")


@query(f"with a as (select {_PART} as part, o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders) select part, o_orderkey, o_custkey, o_totalprice + case when o_orderkey % 5 = 0 and o_orderstatus = 'F' then 1 else 0 end as o_totalprice from a where o_orderdate_ok and not (o_orderkey % 5 = 0 and o_orderstatus = 'P')".replace("o_orderdate_ok", "true"))
def tick_states(spark, sf):
    """STR-05, SNK-17: a first tick over an empty store, then one of changed, vanished and unknown documents"""
    rows = facts(spark, sf).join(t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey").select("part", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    columns = ["part", "o_orderkey", "o_custkey", "o_totalprice"]
    store, pending = publish.Store(spark, scratch(spark, "ticked"), FACTS), scratch(spark, "pending")
    uid = F.col("o_orderkey").cast("string").alias("uid")

    def ticked(source, batch, k):
        fetch = lambda ready: source.join(ready, source["o_orderkey"].cast("string") == ready["uid"], "left_semi").select(*columns)
        ticks.tick(store, "o_orderkey", fetch, lambda asked: source.select(uid), pending)(batch, k)

    ticked(rows, rows.select(uid), 0)
    changed = rows.where("o_orderkey % 5 = 0")
    later = rows.where("not (o_orderkey % 5 = 0 and o_orderstatus = 'P')").withColumn("o_totalprice", F.col("o_totalprice") + ((F.col("o_orderkey") % 5 == 0) & (F.col("o_orderstatus") == "F")).cast("int"))
    ticked(later, changed.select(uid).union(changed.select(F.concat(F.lit("x"), uid))), 1)
    return store.current()


@query(f"with {_SIG}, tail as (select * from sig where updated_at >= timestamp '2024-01-20'), w as (select uid, updated_at - interval 1 day as updated_at from sig) select uid, max(updated_at) as updated_at from (select * from tail union all select * from w) group by 1")
def changed_keys(spark, sf):
    """SET-06: window and tail, the latest of each key"""
    sig = signalled(spark, sf)
    return changes.changed(sig.withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 1 DAY")), sig.where(F.col("updated_at") >= "2024-01-20"))


@query("select distinct o_custkey from orders where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def keys_not_returned(spark, sf):
    """SET-09"""
    orders = t(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    return changes.missing(orders, orders.where("o_orderstatus = 'F'"), "o_custkey")


@query(f"with {_SIG} select uid from sig union select o_orderkey::varchar from orders where o_custkey % 10 = 0 and o_orderdate >= timestamp '{CUT}'")
def changes_with_unresolved(spark, sf):
    """JOI-21: changed keys and recent rows whose link is open"""
    target = t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("uid"), (F.col("o_custkey") % 10).alias("link"), "o_orderdate")
    return changes.with_unresolved(signalled(spark, sf), target, "uid", "link", "o_orderdate", F.lit(CUT).cast("timestamp"))


# ---- keys, trees, links


@query(f"with facts as (select o_custkey as k, min(o_orderkey) as id from orders group by 1), reg as (select o_custkey as k, min(o_orderkey) + 7 as id from orders where o_custkey % 3 = 0 group by 1) select * from reg union all select * from facts where k not in (select k from reg)")
def seeded_registry(spark, sf):
    """KEY-03: keys the registry lacks, with the ids facts have"""
    facts_ = t(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"))
    registry = facts_.where("k % 3 = 0").groupBy("k").agg((F.min("id") + 7).alias("id"))
    return keys.seed(registry, facts_, ["k"])


@query("select n_name as guid, r_name as parent_guid from nation join region on n_regionkey = r_regionkey union all select r_name, null from region union all select c_name, n_name from customer join nation on c_nationkey = n_nationkey")
def completed_tree(spark, sf):
    """KEY-08: missing parents fetched level by level"""
    region, nation, customer = (t(spark, sf, n) for n in ("region", "nation", "customer"))
    known = region.select(F.col("r_name").alias("guid"), F.lit(None).cast("string").alias("parent_guid")).union(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name"))
    leaves = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("guid"), F.col("n_name").alias("parent_guid"))
    unused = known.join(hierarchy.missing_parents(leaves), "guid", "left_anti")  # nations without a customer are asked for by nobody
    done = hierarchy.complete(leaves, lambda asked: known.join(asked, "guid", "left_semi"))
    return done.unionByName(unused.join(done, "guid", "left_anti"))


@query("select c_name as id, n_name as ancestor, n_name as ancestor_name, 1::bigint as distance from customer join nation on c_nationkey = n_nationkey union all select c_name, r_name, r_name, 2 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey union all select n_name, r_name, r_name, 1 from nation join region on n_regionkey = r_regionkey")
def all_ancestors(spark, sf):
    """JOI-19"""
    region, nation, customer = (t(spark, sf, n) for n in ("region", "nation", "customer"))
    nodes = region.select(F.col("r_name").alias("guid"), F.lit(None).cast("string").alias("parent_guid")).union(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")).union(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_name", "n_name"))
    return hierarchy.ancestors(nodes.withColumn("name", F.col("guid")))


_NOW = "timestamp '2000-12-31'"


@query(
    f"with {_LI}, l as (select l_orderkey as doc, l_linenumber as line_no, case when l_linenumber % 3 > 0 and o_orderkey is not null then case when l_linenumber % 3 = 1 and o_orderdate >= {_NOW} - interval 400 day then o_orderkey + 100 when l_linenumber % 3 = 1 then -5 else o_orderkey + 100 end else case when o_orderkey is not null then o_orderkey + 100 end end as header_id, "
    f"case when c_custkey is not null then c_custkey + 0 end as cust, o_custkey, case when k2 is not null then k2 * 7 end as order_id, l_shipdate, o_orderdate from li left join orders on l_orderkey = o_orderkey left join customer on c_custkey = o_custkey and c_custkey % 2 = 0 left join (select o_orderkey as k2 from orders where o_orderstatus = 'F') on k2 = l_orderkey) "
    f"select doc, line_no, header_id, cust is null as customer_was_unknown, order_id from l where not (header_id is not null and header_id <> -5 and o_orderdate >= {_NOW} - interval 400 day and l_shipdate <= o_orderdate + interval 20 day)"
)
def post_load_links(spark, sf):
    """KEY-09, KEY-06, KEY-10: links to the header, stubs and ids of references, a polymorphic link, vanished lines"""
    orders = t(spark, sf, "orders")
    header = orders.select("o_orderkey", (F.col("o_orderkey") + 100).alias("id"), F.col("o_orderdate").alias("etl_updated_at"))
    refs = S.pack_refs({"customer": uuid_of(F.col("o_custkey")), "order.uid": uuid_of(F.col("o_orderkey")), "order.type": F.lit(476)})
    wrong = F.when(F.col("l_linenumber") % 3 == 1, F.lit(-5)).when(F.col("l_linenumber") % 3 == 2, F.col("o_orderkey") + 100).cast("bigint")
    fact = lines(spark, sf).join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line_no"), wrong.alias("header_id"), refs.alias("raw_refs"), F.lit(None).cast("bigint").alias("customer_id"), F.lit(None).cast("bigint").alias("order_id"), F.col("l_shipdate").alias("etl_updated_at"))
    dim = t(spark, sf, "customer").where("c_custkey % 2 = 0").select(uuid_of(F.col("c_custkey")).alias("guid"), F.col("c_custkey").alias("id"), F.lit(False).alias("is_stub"))
    register = orders.where("o_orderstatus = 'F'").select(uuid_of(F.col("o_orderkey")).alias("uid"), F.lit(476).alias("code"), (F.col("o_orderkey") * 7).alias("id"))
    links = keys.links_of(["raw_refs.customer", "raw_refs.order.uid", "raw_refs.order.type"], ["dim_customer"], {"order": "orders"})
    fk = keys.fk_column(["header_id"], "headers")
    out, grown = loads.post_load(fact, header, {"doc": "o_orderkey"}, fk, {n: dim for n, (sort, _) in links.items() if sort == "dim"}, {n: register for n, (sort, _) in links.items() if sort == "document"}, now=ts("2000-12-31"), recent="INTERVAL 400 DAYS", older="INTERVAL -20 DAYS")
    stubs = grown["customer"].where("is_stub").select(F.col("id").alias("stub"))
    return out.join(stubs, F.col("customer_id") == F.col("stub"), "left").select("doc", "line_no", "header_id", F.col("stub").isNotNull().alias("customer_was_unknown"), "order_id")


@query(f"select o_orderkey, coalesce(case when c_custkey is not null then {uuid_sql('c_custkey')} end, '{S.ZERO_UUID}') as partner from orders left join (select c_custkey from customer where c_nationkey < 20) on o_custkey = c_custkey")
def expanded_references(spark, sf):
    """JOI-16: ids back to guids, the zero reference where there is none"""
    dim = t(spark, sf, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("id"), uuid_of(F.col("c_custkey")).alias("guid"))
    return integrity.expand_refs(t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("partner")), {"partner": dim})


# ---- state and journals


@query(f"with {_RUNS}, j as (select user_id, run_id, ts as started_at, status, 'load' as path, case when user_id % 5 <> 0 then 'target ' || user_id end as target_table, 10::bigint as n_rows, null::varchar as checkpoint_value from runs where run_id % 2 = 0 union all select user_id, run_id, ts, status, 'sync', 'sync ' || user_id, 20, 'partition ' || (run_id % 12) from runs where run_id % 2 = 1 and user_id % 3 <> 0) select * exclude (k) from (select *, row_number() over (partition by user_id order by started_at desc nulls last, path, run_id desc) as k from j) where k <= 20")
def run_journal(spark, sf):
    """SET-08, JOI-23, SRT-05: the last 20 runs of each register over both journals"""
    r = runs(spark, sf).withColumn("started_at", F.col("ts"))
    users = r.select("user_id").distinct()
    targets = users.where("user_id % 5 <> 0").select(F.col("user_id").alias("id"), F.concat(F.lit("target "), F.col("user_id").cast("string")).alias("target_table"))
    configs = users.select(F.col("user_id").alias("id"), "user_id", F.concat(F.lit("sync "), F.col("user_id").cast("string")).alias("target_table"), (F.col("user_id") % 3 != 0).alias("is_active"))
    load_runs = r.where("run_id % 2 = 0").select("user_id", "run_id", "started_at", "status", F.col("user_id").alias("target_id"), F.lit(10).cast("bigint").alias("n_rows"), F.lit(None).cast("string").alias("checkpoint_value"))
    syncs = r.where("run_id % 2 = 1").select("run_id", "started_at", "status", F.col("user_id").alias("sync_id"), F.lit(20).cast("bigint").alias("n_rows"), (F.col("run_id") % 12).alias("part"))
    return state.journal(load_runs, targets, syncs, configs, "user_id", 20)


@query("with s as (select user_id, max(ts) as at, count(*) as n from events where event_type <> 'error' group by 1), f as (select user_id, max(ts) as at from events where event_type = 'error' group by 1) select coalesce(s.user_id, f.user_id) as user_id, case when f.user_id is not null then 'failed' else 'ok' end as status, s.n as n_rows, s.at as last_ok, case when f.user_id is not null then 'lost' end as last_error from s full join f on s.user_id = f.user_id")
def source_state(spark, sf):
    """STR-15: a failure keeps what the last success knew"""
    ev = t(spark, sf, "events")
    known = ev.where("event_type <> 'error'").groupBy("user_id").agg(F.lit("ok").alias("status"), F.count("*").alias("n_rows"), F.max("ts").alias("last_ok"), F.lit("none").alias("last_error")).withColumn("last_error", F.lit(None).cast("string"))
    news = ev.where("event_type = 'error'").groupBy("user_id").agg(F.lit("failed").alias("status"), F.lit(None).cast("bigint").alias("n_rows"), F.lit("lost").alias("last_error"))
    return state.save_state(known, news, ["user_id"])


@query("select user_id, arg_max(event_id::varchar, (ts, event_id)) as checkpoint_value from events where event_type = 'purchase' group by 1")
def last_watermarks(spark, sf):
    """STR-20: the last success with a checkpoint"""
    h = t(spark, sf, "events").select("user_id", F.col("event_id").alias("id"), F.col("ts").alias("finished_at"), F.when(F.col("event_type") == "purchase", "success").otherwise("failed").alias("status"), F.col("event_id").cast("string").alias("checkpoint_value"))
    return state.last_checkpoints(h, "user_id")


@query("select user_id, case when user_id % 2 = 0 then strftime(max(ts) - interval 2 hour, '%Y-%m-%d %H:%M:%S') else strftime(timestamp '2024-01-01' - interval 2 hour, '%Y-%m-%d %H:%M:%S') end as checkpoint_value from events group by 1")
def backfilled_watermarks(spark, sf):
    """STR-20: a watermark set a gap before a backfill's start is the next one read"""
    per = t(spark, sf, "events").groupBy("user_id").agg(F.date_trunc("second", F.max("ts")).alias("start"))
    row = per.select("user_id", F.lit(2).cast("bigint").alias("id"), ts("2024-06-01").alias("finished_at"), F.lit("success").alias("status"), F.when(F.col("user_id") % 2 == 0, F.col("start")).otherwise(ts("2024-01-01")).cast("string").alias("checkpoint_value"))
    old = row.select("user_id", F.lit(1).cast("bigint").alias("id"), ts("2024-05-01").alias("finished_at"), "status", F.lit("older").alias("checkpoint_value"))
    return state.last_checkpoints(state.set_watermark(old, row, "INTERVAL 2 HOURS"), "user_id").withColumn("checkpoint_value", F.substring("checkpoint_value", 1, 19))


@query("select 'dims' as name, count(*) as n from customer union all select 'facts', count(*) from lineitem")
def isolated_groups(spark, sf):
    """STR-21: groups run apart, and failures come together at the end"""
    count = lambda name, table: lambda: t(spark, sf, table).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
    return integrity.together(list(state.isolated({"dims": count("dims", "customer"), "facts": count("facts", "lineitem")}).values()))


@query(f"with {_DIM}, changed as (select * from src where marked_at > (select max(marked_at) from dim)) select 'initial' as mode, (select count(*) from dim) as n, (select count(*) from dim where name like '%!') as n_named union all select 'reload', (select count(*) from dim), (select count(*) from dim) union all select 'register', (select count(*) from dim) + (select count(*) from changed where guid not in (select guid from dim)), (select count(*) from changed) union all select 'update', (select count(*) from dim), (select count(*) from changed where guid in (select guid from dim))")
def dimension_modes(spark, sf):
    """STR-18: a dimension with rows after a load of each mode"""
    dim, source = dim_frames(spark, sf)
    after = {m: dimensions.by_mode(dim, source, m, "guid", ["name"], "marked_at") for m in ("initial", "reload", "register", "update")}
    return integrity.together([df.agg(F.lit(m).alias("mode"), F.count("*").alias("n"), F.count_if(F.endswith("name", F.lit("!"))).alias("n_named")) for m, df in after.items()])


@query(f"with {_DIM}, changed as (select * from src where marked_at > (select max(marked_at) from dim)) select d.guid, coalesce(c.name, d.name) as name, timestamp '2024-04-01' as marked_at from dim d left join changed c on c.guid = d.guid")
def snapshot_mark(spark, sf):
    """STR-19, SNK-12: one snapshot mark in place of each row's own"""
    dim, source = dim_frames(spark, sf)
    return dimensions.by_mode(dim, source, "update", "guid", ["name"], "marked_at", snapshot=ts("2024-04-01")).select("guid", "name", "marked_at")


@query(f"with {_BASE} select count(*) as n_rows, 0::bigint as n_other, count(*) as n_same from base")
def guarded_upsert(spark, sf):
    """SNK-13: a guarded load of equal rows leaves ids and rows as they were"""
    target = base(spark, sf).withColumn("id", F.col("o_orderkey") * 3)
    again = merge.upsert(target, target.drop("id"), ["o_orderkey"], guard=True)
    same = again.join(target.select(F.col("o_orderkey").alias("k"), F.col("id").alias("was")), F.col("o_orderkey") == F.col("k"), "left")
    return same.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("id").eqNullSafe(F.col("was"))).alias("n_other"), F.count_if(F.col("id") == F.col("was")).alias("n_same"))


# ---- integrity and reports


@query("select 'empty:lines' as \"check\", 0::bigint as bad union all select 'null:lines.l_partkey', count(*) filter (where l_partkey is null) from lineitem union all select 'unresolved:lines.order_id', count(*) filter (where l_orderkey % 10 = 0 and l_returnflag <> 'N') from lineitem union all select 'twice:lines', (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) union all select 'empty:gone', 1 union all select 'null:gone.l_partkey', 0")
def load_findings(spark, sf):
    """CHK-01: the suite over a table with faults and one without rows"""
    li = t(spark, sf, "lineitem").withColumn("order_id", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")))
    return integrity.load_suite({"lines": li, "gone": li.limit(0)}, {"lines": ["l_orderkey", "l_linenumber"]}, {"lines": ["l_partkey"], "gone": ["l_partkey"]}, {"lines": {"order_id": F.col("l_returnflag") != "N"}})


def linked(spark, sf):
    """Lines whose link is missing, right or to nowhere, and headers with their ids."""
    header = t(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", (F.col("o_orderkey") + 9).alias("id"))
    link = F.when(F.col("l_linenumber") % 4 == 1, F.lit(-1)).when(F.col("l_linenumber") % 4 != 0, F.col("l_orderkey") + 9).cast("bigint")
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", link.alias("header_id")), header


_LIVING = "l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'P')"


@query(f"select 'fk_null_with_parent' as \"check\", count(*) as bad from lineitem where l_linenumber % 4 = 0 and {_LIVING} union all select 'fk_dangling', count(*) from lineitem where l_linenumber % 4 = 1 or (l_linenumber % 4 in (2, 3) and not ({_LIVING})) union all select 'dup_child_nk', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) union all select 'dup_parent_nk', 0")
def link_integrity(spark, sf):
    """CHK-08: a child table and its parent"""
    child, header = linked(spark, sf)
    return integrity.link_findings(child, header, {"l_orderkey": "o_orderkey"}, "header_id", ["l_orderkey", "l_linenumber"], ["o_orderkey"])


@query(f"select 'first' as pass, l_orderkey, l_linenumber, case when l_linenumber % 4 = 1 then -1 end::bigint as header_id, l_orderkey + 9 as proposed from lineitem where l_linenumber % 4 in (0, 1) and {_LIVING}")
def proposed_repairs(spark, sf):
    """CHK-08: links proposed, and none in a second pass over the repaired rows"""
    child, header = linked(spark, sf)
    on = {"l_orderkey": "o_orderkey"}
    first = integrity.proposed_links(child, header, on, "header_id").withColumn("pass", F.lit("first"))
    return first.unionByName(integrity.proposed_links(integrity.repaired(child, header, on, "header_id"), header, on, "header_id").withColumn("pass", F.lit("second")))


@query("select 'stub_rows' as \"check\", count(*) as bad from customer where c_custkey % 4 <> 0 and c_custkey % 5 = 0 union all select 'dup_key', 0")
def dimension_integrity(spark, sf):
    """CHK-09"""
    return integrity.dimension_findings(dim_frames(spark, sf)[0], "guid")


@query("select 'zero:o_custkey' as \"check\", count(*) filter (where coalesce(o_custkey = 0, true)) as bad from orders union all select 'unique:o_orderkey', 0 union all select 'orphan:customer', count(*) from orders where o_custkey not in (select c_custkey from customer where c_nationkey < 20) union all select 'registry:missing', count(*) from orders where o_orderkey % 7 = 0 union all select 'registry:other_id', count(*) from orders where o_orderkey % 7 <> 0 and o_orderkey % 50 = 0 union all select 'registry:keys_with_many_ids', 0 union all select 'registry:ids_with_many_keys', 0")
def integrity_gate(spark, sf):
    """CHK-07: keys twice, zeroes, orphans and other ids than the registry's"""
    fact = facts(spark, sf).withColumn("id", F.col("o_orderkey") + (F.col("o_orderkey") % 50 == 0).cast("int"))
    registry = t(spark, sf, "orders").where("o_orderkey % 7 <> 0").select("o_orderkey", F.col("o_orderkey").alias("id"))
    return integrity.gate(fact, replace(FACTS, not_zero=("o_custkey",)), {"customer": (t(spark, sf, "customer").where("c_nationkey < 20"), {"o_custkey": "c_custkey"})}, (registry, ["o_orderkey"], "id"))


@query(f"select 'orders' as name, 'closed_unequal' as \"check\", (select count(distinct {_PART}) from orders where o_orderkey % 500 = 3 and {_PART} between 199601 and 199711) as bad union all select 'orders', 'open_unequal', (select count(distinct {_PART}) from orders where o_orderkey % 500 = 3 and {_PART} in (199712, 199801)) union all select 'orders', 'unique:o_orderkey', 0")
def verification_report(spark, sf):
    """CHK-11, CHK-05, FLT-12: closed and open partitions since history began, and the configured checks"""
    rows = facts(spark, sf).where("part <= 199801")
    other = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 500 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return integrity.verification({"orders": (rows, other, FACTS)}, history=199601, open_parts=[199712, 199801])


@query(f"select distinct 'orders' as name, 'unequal' as problem, {_PART} as part from orders where o_orderkey % 500 = 3 and {_PART} < 199712 union all select 'nothing', 'empty', null union all select distinct 'nothing', 'unequal', {_PART} from orders where {_PART} < 199712")
def cutover_preconditions(spark, sf):
    """CHK-23"""
    rows = facts(spark, sf).where("part <= 199801")
    other = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 500 == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return integrity.cutover_problems({"orders": (rows, other, FACTS), "nothing": (rows, rows.limit(0), FACTS)}, [199712, 199801])


@query(f"with u as (select 'F' as st, {_PART} as part, o_orderkey::varchar as doc, {uuid_sql('o_custkey')} as partner, '{S.ZERO_UUID}' as item, o_totalprice::decimal(18,4) as amount from orders where o_orderstatus = 'F' union all select 'O', {_PART}, o_orderkey::varchar, '{S.ZERO_UUID}', {uuid_sql('o_orderkey')}, 0 from orders where o_orderstatus = 'O') select part, count(*) as n, sum(('0x' || substr(md5(concat_ws('|', doc, partner, item)), 1, 8))::bigint)::double as checksum, sum(amount)::double as sum_amount from u group by 1")
def reconcile_plan(spark, sf):
    """CHK-04: members with their own references and measures in one canonical form"""
    rows = parted(spark, sf)
    f = (rows.where("o_orderstatus = 'F'"), {"doc": F.col("o_orderkey")}, {"partner": F.upper(uuid_of(F.col("o_custkey")))}, {"amount": F.col("o_totalprice")})
    o = (rows.where("o_orderstatus = 'O'"), {"doc": F.col("o_orderkey")}, {"item": uuid_of(F.col("o_orderkey"))}, {})
    alike = integrity.members_alike([f, o], ["doc"], ["partner", "item", "nobody"], ["amount", "none"], "part")
    return double(fingerprint.fingerprint(alike, ["doc", "partner", "item"], ["amount"], ["part"]), "checksum", "sum_amount").drop("sq_amount")


@query(f"select {_PART} as part, {_FP}, sum(o_totalprice::decimal(19,4) * o_totalprice::decimal(19,4))::double as sq_o_totalprice from orders group by 1")
def partition_squares(spark, sf):
    """AGG-05, AGG-06: with the sum of squares"""
    return double(fingerprint.fingerprint(parted(spark, sf), SPEC.checksum, SPEC.measures, ["part"]), "checksum", "sum_o_totalprice", "sq_o_totalprice")


@query(f"select o_custkey, {_FP}, sum(o_totalprice::decimal(19,4) * o_totalprice::decimal(19,4))::double as sq_o_totalprice from orders group by 1")
def document_squares(spark, sf):
    """AGG-07: with the sum of squares"""
    return double(fingerprint.fingerprint(t(spark, sf, "orders"), SPEC.checksum, SPEC.measures, ["o_custkey"]), "checksum", "sum_o_totalprice", "sq_o_totalprice")


@query("with a as (select o_custkey as doc, o_orderstatus as type, o_orderdate::date as day, sum(o_totalprice::decimal(18,4))::double as amount from orders group by all), b as (select o_custkey as doc, o_orderstatus as type, o_orderdate::date as day, sum(o_totalprice::decimal(18,4))::double as amount from orders where o_orderkey % 19 <> 0 group by all) select coalesce(a.doc, b.doc) as doc, coalesce(a.type, b.type) as type, coalesce(a.day, b.day) as day, coalesce(a.amount, 0) as amount_a, coalesce(b.amount, 0) as amount_b, round(coalesce(a.amount, 0) - coalesce(b.amount, 0), 2) as amount_delta from a full join b on a.doc = b.doc and a.type = b.type and a.day = b.day where abs(coalesce(a.amount, 0) - coalesce(b.amount, 0)) > 0.01")
def document_deltas(spark, sf):
    """CHK-14: what differs by document, type and day"""
    per = lambda df: df.groupBy(F.col("o_custkey").alias("doc"), F.col("o_orderstatus").alias("type"), F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).cast("double").alias("amount"))
    orders = t(spark, sf, "orders")
    out = checks.reconcile(per(orders), per(orders.where("o_orderkey % 19 <> 0")), ["doc", "type", "day"], ["amount"]).where("verdict = 'DIFF'").drop("verdict")
    return out.withColumn("amount_delta", F.round("amount_delta", 2))


@query("select event_type, count(distinct user_id) as n_docs, count(*) as n_rows, sum(value) filter (where event_id % 17 <> 0) as sum_v, count(*) filter (where event_id % 17 = 0) as nan_v, round(count(*) filter (where value < 20) * 100.0 / count(*), 4)::double as inactive_pct from events group by 1")
def type_audit(spark, sf):
    """CHK-15, AGG-13: sums without NaN, and the inactive share"""
    rows = t(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 17 == 0, float("nan")).otherwise(F.col("value")))
    return audit.type_audit(rows, "event_type", "user_id", ["v"], F.col("value") < 20).withColumn("inactive_pct", F.col("inactive_pct").cast("double"))


@query(f"with {_LI} select l_returnflag, count(*) filter (where l_quantity < 5) as n_bad, count(*) filter (where l_quantity < 5 and o_custkey % 3 = 0) as n_bad_parent_bad, count(*) filter (where l_quantity >= 5 and o_custkey % 3 = 0) as n_fine_parent_bad, count(*) as n_rows from li join orders on l_orderkey = o_orderkey group by 1")
def bad_by_parent(spark, sf):
    """CHK-16: missing values beside their parents'"""
    rows = lines(spark, sf).join(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return audit.null_by_parent(rows, "l_returnflag", F.col("l_quantity") < 5, F.col("o_custkey") % 3 == 0)


@query("select l_returnflag, count(*) filter (where l_shipdate < o_orderdate) as n_inverted, count(*) filter (where o_orderdate > timestamp '1998-06-01' or l_shipdate > timestamp '1998-06-01') as n_future from lineitem join orders on l_orderkey = o_orderkey group by 1")
def time_inversions(spark, sf):
    """CHK-17"""
    rows = t(spark, sf, "lineitem").join(t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return audit.inversions(rows, "o_orderdate", "l_shipdate", ts("1998-06-01"), ["l_returnflag"])


@query("select round(epoch_us(timestamp '2024-02-01') / 1e6 - (select epoch_us(max(ts)) from events) / 1e6, 3) as source_s, round(epoch_us(timestamp '2024-02-01') / 1e6 - (select epoch_us(max(o_orderdate)) from orders) / 1e6, 3) as data_s, round(epoch_us(timestamp '2024-02-01') / 1e6 - (select epoch_us(max(ts)) from events where event_type = 'view') / 1e6, 3) as pipeline_s")
def three_lags(spark, sf):
    """CHK-18: source, data and pipeline"""
    ev = t(spark, sf, "events")
    return audit.lags(ev, "ts", t(spark, sf, "orders"), "o_orderdate", ev.where("event_type = 'view'"), "ts", ts("2024-02-01"))


@query(f"with {_SIG} select updated_at < timestamp '2024-01-29' as scanned, uid in (select o_orderkey::varchar from orders) as present, count(*) as n from sig group by 1, 2")
def backlog_split(spark, sf):
    """CHK-18: scanned and not, present and absent"""
    return audit.backlog(signalled(spark, sf), t(spark, sf, "orders"), "o_orderkey", ts("2024-01-29"))


@query("select hour(date_trunc('second', ts))::int as hour, count(*) as n_runs, min(user_id % 50)::double as least, max(user_id % 50)::double as largest, round(avg(user_id % 50), 3) as mean from events group by 1")
def window_lengths(spark, sf):
    """CHK-19, SCL-26: windows read from the checkpoint text of runs"""
    end = F.date_trunc("second", "ts")
    begin = F.timestamp_seconds(F.unix_seconds(end.cast("timestamp_ltz")) - F.col("user_id") % 50 * 60)
    text = F.concat(F.lit("from="), F.date_format(begin, "yyyy-MM-dd HH:mm:ss"), F.lit("; to="), F.date_format(end, "yyyy-MM-dd HH:mm:ss"))
    return audit.run_windows(t(spark, sf, "events").select(text.alias("checkpoint")), "checkpoint")


@query("select case when l_shipdate < o_orderdate + interval 30 day and l_shipdate >= o_orderdate then 'month' when l_shipdate >= o_orderdate + interval 30 day and l_shipdate < o_orderdate + interval 90 day then 'quarter' else 'other' end as class, count(*) as n, min(epoch(l_shipdate) - epoch(o_orderdate))::double as least, max(epoch(l_shipdate) - epoch(o_orderdate))::double as largest from lineitem join orders on l_orderkey = o_orderkey group by 1")
def delta_classes(spark, sf):
    """AGG-21"""
    rows = t(spark, sf, "lineitem").join(t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return audit.delta_classes(rows, "o_orderdate", "l_shipdate", {"month": ("0 DAYS", "30 DAYS"), "quarter": ("30 DAYS", "90 DAYS")})


@query(f"with a as (select {_PART} as month, count(*) as n, sum(o_totalprice::decimal(18,4)) as amount from orders group by 1), b as (select {_PART} as month, count(*) as n, sum(o_totalprice::decimal(18,4)) as amount from orders where o_orderkey % 40 <> 0 group by 1) select month, n_a, n_b, amount_a::double as amount_a, amount_b::double as amount_b, greatest(round(abs(n_a - n_b)::double / greatest(abs(n_a), 1) * 100, 4), round(abs(amount_a::double - amount_b::double) / greatest(abs(amount_a::double), 1) * 100, 4)) as worst_pct from (select coalesce(a.month, b.month) as month, coalesce(a.n, 0) as n_a, coalesce(b.n, 0) as n_b, coalesce(a.amount, 0) as amount_a, coalesce(b.amount, 0) as amount_b from a full join b on a.month = b.month)")
def light_months(spark, sf):
    """AGG-25: rows and sums by month of both sides"""
    orders = t(spark, sf, "orders")
    return double(audit.light_check(orders, orders.where("o_orderkey % 40 <> 0"), S.partition_key(F.col("o_orderdate")), {"amount": "o_totalprice"}), "amount_a", "amount_b")


@query("select distinct case o_orderstatus when 'F' then 476 when 'O' then 415 when 'P' then 254 end::bigint as code from orders")
def document_types(spark, sf):
    """AGG-30, SCL-06: the catalogue of types, kept as four bytes"""
    return audit.types_of(t(spark, sf, "orders").select(F.unhex(F.lpad(F.hex(kind()), 8, "0")).alias("code")), "code")


@query("with c as (select l_shipdate::date as day, l_returnflag as type, sum(l_extendedprice::decimal(18,4))::double as cost from lineitem where l_shipdate::date::varchar not like '%-13' group by 1, 2), j as (select c.type, c.day, c.cost, lag(c.cost) over (partition by c.type order by c.day) as previous, a.cost as ago_7, b.cost as ago_30 from c left join c a on a.type = c.type and a.day = c.day - 7 left join c b on b.type = c.type and b.day = c.day - 30) select *, case when abs(round((cost - previous) / nullif(abs(previous), 0) * 100, 4)) >= 1 then round((cost - previous) / nullif(abs(previous), 0) * 100, 4) end as previous_pct, case when abs(round((cost - ago_7) / nullif(abs(ago_7), 0) * 100, 4)) >= 1 then round((cost - ago_7) / nullif(abs(ago_7), 0) * 100, 4) end as ago_7_pct, case when abs(round((cost - ago_30) / nullif(abs(ago_30), 0) * 100, 4)) >= 1 then round((cost - ago_30) / nullif(abs(ago_30), 0) * 100, 4) end as ago_30_pct from j")
def cost_snapshots(spark, sf):
    """WIN-11: a day beside the snapshot before, 7 and 30 days ago"""
    costs = t(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("type")).agg(F.sum(money("l_extendedprice")).cast("double").alias("cost"))
    return audit.snapshot_changes(costs.where("day(day) <> 13"), ["type"], "day", "cost")


@query(f"with {_LI} select * from (select l_suppkey, l_partkey, sum((case when l_linestatus = 'O' then 1 else -1 end) * l_quantity::decimal(18,4))::double as quantity, sum((case when l_linestatus = 'O' then 1 else -1 end) * l_extendedprice::decimal(18,4))::double as amount, max(l_shipdate) as last_at from li where l_returnflag <> 'R' group by 1, 2) where quantity <> 0")
def stock_active(spark, sf):
    """AGG-01, FLT-06: movements that are not active count nowhere"""
    rows = lines(spark, sf).select("l_suppkey", "l_partkey", (F.col("l_linestatus") != "O").cast("int").alias("kind"), money("l_quantity").alias("quantity"), money("l_extendedprice").alias("amount"), "l_shipdate", (F.col("l_returnflag") != "R").alias("is_active"))
    return double(audit.stock_current(rows, ["l_suppkey", "l_partkey"], "kind", "quantity", "amount", "l_shipdate", F.col("is_active")), "quantity", "amount")


@query("select 'c_name' as column_name, 'missing' as change, count(*) as n from customer union all select 'c_acctbal', 'widened', count(*) from customer union all select 'c_custkey', 'narrowed', count(*) from customer union all select 'new', 'extra', count(*) from customer")
def schema_drift(spark, sf):
    """CHK-21, CHK-22: have against want, beside the rows it would touch"""
    want = t(spark, sf, "customer")
    have = want.drop("c_name").withColumns({"c_custkey": F.col("c_custkey").cast("string"), "c_acctbal": F.col("c_acctbal").cast("float"), "new": F.lit(1)})
    found = checks.schema_changes(have.schema, want.schema)
    if checks.schema_changes(want.schema, want.schema):
        raise ValueError("a schema differs from itself")
    return spark.createDataFrame(found, "column_name string, change string").join(F.broadcast(want.agg(F.count("*").alias("n"))))


# ---- scalar functions


@query("select event_id, user_id as n, user_id as back, event_id % 2 = 1 as odd, event_id % 2 = 0 as even from events")
def binary_values(spark, sf):
    """SCL-06, SCL-07, SCL-09: four bytes in both orders, one byte, and its contrary"""
    h = F.lpad(F.hex("user_id"), 8, "0")
    turned = F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)])
    odd = S.binary_to_bool(F.unhex(F.format_string("%02d", F.col("event_id") % 2)))
    return t(spark, sf, "events").select("event_id", S.binary_to_int(F.unhex(h)).alias("n"), S.binary_to_int(F.unhex(turned), little=True).alias("back"), odd.alias("odd"), S.invert_bool(odd).alias("even"))


@query("select o_orderkey, case o_orderstatus when 'F' then 'done' when 'O' then 'open' else o_orderstatus end as status from orders")
def code_names(spark, sf):
    """SCL-10: an unknown code stays"""
    return t(spark, sf, "orders").select("o_orderkey", S.lookup(F.col("o_orderstatus"), {"F": "done", "O": "open"}).alias("status"))


@query("select o_orderkey, case when o_orderkey % 10 > 0 then date_trunc('second', o_orderdate) end as at from orders")
def parsed_dates(spark, sf):
    """SCL-13: either calendar, or null"""
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    far = F.when(F.col("o_orderkey") % 2 == 0, F.concat((F.year("o_orderdate") + 2000).cast("string"), F.substring(text, 5, 20))).otherwise(text)
    return t(spark, sf, "orders").select("o_orderkey", S.parse_date(F.when(F.col("o_orderkey") % 10 > 0, far).otherwise("soon")).alias("at"))


@query("select event_id, case when event_id % 3 = 0 then null else event_id % 5 <> 0 end as number, case event_id % 3 when 0 then true when 1 then false end as word from events")
def truth_values(spark, sf):
    """SCL-17: numbers by their truth, words by the list"""
    e = F.col("event_id")
    word = F.element_at(F.array(F.lit("ДА"), F.lit("нет "), F.lit("2")), (e % 3 + 1).cast("int"))
    return t(spark, sf, "events").select("event_id", S.cast(F.when(e % 3 != 0, (e % 5).cast("double")), "bool").alias("number"), S.to_bool(word).alias("word"))


@query("select o_orderkey, (case o_orderkey % 5 when 0 then -1 when 1 then 1 when 2 then -1 when 3 then 1 else 0 end)::int as sign from orders")
def reference_signs(spark, sf):
    """SCL-21: by the names of the reference's documents; the till counts 1 unless its operation is a return"""
    k = F.col("o_orderkey") % 5
    names = F.element_at(F.array(*[F.lit(x) for x in ("ВозвратТоваровОтПокупателя", "РеализацияТоваровУслуг", "ЧекККМ", "ЧекККМ", "ЗаказПокупателя")]), (k + 1).cast("int"))
    return t(spark, sf, "orders").select("o_orderkey", S.doc_sign(names, F.when(k == 2, "Возврат").when(k == 3, "Продажа")).alias("sign"))


@query("select unnest([199612, 199701]) as month, 2::bigint as n where (select count(*) from orders) > 0 union all select m, 12 from (select unnest(range(199601, 199613)) as m) where (select count(*) from orders) > 0 union all select m, 6 from (select unnest(range(199701, 199707)) as m) where (select count(*) from orders) > 0")
def months_to_check(spark, sf):
    """SCL-29: in January with last December, of a whole year, and up to June"""
    some = t(spark, sf, "orders").agg(F.count("*").alias("rows")).where("rows > 0")
    lists = F.array(S.months_of(1997, ts("1997-01-20")), S.months_of(1996, ts("1997-01-20")), S.months_of(1997, ts("1997-06-30")), S.months_of(1998, ts("1997-06-30")))
    return some.select(F.explode(lists).alias("m")).select(F.explode("m").alias("month"), F.size("m").cast("bigint").alias("n"))


@query("select o_orderkey, round(o_totalprice, 8) as form, 0.0::double as none from orders")
def measure_form(spark, sf):
    """SCL-31: a measure's comparable form"""
    return double(t(spark, sf, "orders").select("o_orderkey", S.metric(F.col("o_totalprice")).alias("form"), S.metric(F.lit(None).cast("double")).alias("none")), "form", "none")


@query(f"select o_orderkey, {uuid_sql('o_custkey')} as partner, null::varchar as shop, {uuid_sql('o_orderkey')} as kept from orders")
def references_set(spark, sf):
    """SCL-35: one reference put in, one taken out, one left"""
    refs = S.pack_refs({"shop": uuid_of(F.col("o_custkey")), "kept": uuid_of(F.col("o_orderkey"))})
    put = S.set_ref(S.set_ref(refs, "partner", uuid_of(F.col("o_custkey"))), "shop", F.lit(None).cast("string"))
    return t(spark, sf, "orders").select("o_orderkey", *[S.ref_uid(put, k).alias(k) for k in ("partner", "shop", "kept")])


@query("select c_custkey, replace(c_name, '#', ' ') as name from customer")
def tidy_names(spark, sf):
    """SCL-38"""
    messy = F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("  \t ")), F.lit("  "))
    return t(spark, sf, "customer").select("c_custkey", S.tidy(messy).alias("name"))


@query("select count(*) as n, 0::bigint as n_other, (select count(*) from orders where o_orderkey % 9 = 0) as n_changed from orders")
def hashed_rows(spark, sf):
    """SCL-40: equal rows have equal hashes, changed ones do not"""
    rows = t(spark, sf, "orders").withColumn("new", F.col("o_totalprice") + (F.col("o_orderkey") % 9 == 0).cast("int"))
    a, same, b = (S.content_hash(F.col("o_orderkey"), c) for c in (F.col("o_totalprice"), F.col("o_totalprice") + 0.0, F.col("new")))
    return rows.agg(F.count("*").alias("n"), F.count_if(a != same).alias("n_other"), F.count_if(a != b).alias("n_changed"))


# ---- feeds read from CSV files, and a rebuild


def as_csv(spark, df, name, sep=","):
    """``df`` as CSV files with a header in the shared folder."""
    path = scratch(spark, name)
    df.write.csv(path, header=True, sep=sep)
    return path


@query("select event_id, case when event_id % 9 = 0 then 0.0 else user_id::double end as units, case when event_id % 4 = 0 then '' else event_type end as city from events")
def sales_csv(spark, sf):
    """SRC-08: bad numbers as 0, missing text as empty"""
    rows = t(spark, sf, "events").select(F.col("event_id").cast("string").alias("ID"), F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("SALES UNITS"), F.when(F.col("event_id") % 4 != 0, F.col("event_type")).alias("CITY"))
    out = csvs.sales_report(spark, as_csv(spark, rows, "sales-csv"), {"ID": "event_id", "SALES UNITS": "units", "CITY": "city"}, ["event_id", "units"], ts("2024-02-01"))
    return out.select(F.col("event_id").cast("bigint").alias("event_id"), "units", "city")


@query("select p_partkey::varchar as \"ID\", p_size + 0.5 as \"ZZZ\", p_brand as \"Segment11\" from part")
def product_csv(spark, sf):
    """SRC-09: semicolons, decimal commas, an unnamed column"""
    path = scratch(spark, "product-csv")
    line = F.concat_ws(";", F.col("p_partkey").cast("string"), F.concat(F.col("p_size").cast("string"), F.lit(",5")), "p_brand")
    spark.range(1).select(F.lit("ID;ZZZ;").alias("value")).union(t(spark, sf, "part").select(line)).coalesce(1).write.text(path)  # one file, as the feed is
    return csvs.product_report(spark, path)


@query("select lower(c_name) as email, c_mktsegment as division from customer")
def user_csv(spark, sf):
    """SRC-10: fixed names, trimmed text, further columns left out"""
    rows = t(spark, sf, "customer").select(F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("a"), F.col("c_mktsegment").alias("b"), F.lit("x").alias("c"))
    return csvs.user_sheet(spark, as_csv(spark, rows, "user-csv"), ["email", "division"], ts("2024-02-01")).drop("etl_loaded_at")


@query("select p_partkey::varchar as product_id, (p_size * 1000)::double as max_asp, date '2024-02-01' + (p_size % 20)::int as start_date, null::date as end_date from part")
def price_cap_csv(spark, sf):
    """SRC-11: numbers with inner spaces, dates by day, empty columns dropped"""
    rows = t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("Product"), F.concat(F.col("p_size").cast("string"), F.lit(" 000")).alias("Max"), F.lit(None).cast("string").alias("Empty"), F.date_format(F.date_add(F.lit("2024-02-01").cast("date"), F.col("p_size") % 20), "dd.MM.yyyy").alias("From"), F.lit("nan").alias("To"))
    return csvs.price_caps(spark, as_csv(spark, rows, "cap-csv"))


@query(f"select {_PART} as part, count(*) as n, sum(o_totalprice::decimal(18,4))::double as amount from orders where {_PART} >= 199701 group by 1")
def rebuilt_period(spark, sf):
    """PIP-08: a load, its validation, and a strict reconciliation with the source"""
    rows = facts(spark, sf).where("part >= 199701")
    store = publish.Store(spark, scratch(spark, "rebuilt"), FACTS)
    parts = sorted(r[0] for r in rows.select("part").distinct().collect())  # a row a month
    suite = lambda: integrity.load_suite({"orders": store.current()}, {"orders": ["o_orderkey"]}, {"orders": ["o_custkey"]}, {})
    loads.rebuild(lambda: store.publish(rows, parts), suite, lambda: store.sweep(rows))
    return store.current().groupBy("part").agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("amount"))
