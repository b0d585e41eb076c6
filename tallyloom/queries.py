"""Registered queries over the driver's tables, and the same results in DuckDB's SQL.

orders / lineitem stand for document headers / lines, events for change signals and run journals,
customer, supplier, part and nation for dimensions.  (order, line number) is not unique in lineitem,
so queries by line keep the first row of each in a total order, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import scalars as S
from tallyloom.operators import audit, changes, checks, datasets, dimensions, fingerprint, hierarchy, keys, merge
from tallyloom.plans import publish
from tallyloom.sources import relational
from tallyloom.specs import ColumnSpec, PublishSpec, SourceSpec, TargetSpec, UnionSpec
from tallyloom.staged import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

LINE_ORDER = ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
#: Document type codes by order status, and the day that parts old from changed orders.
TYPES = {"F": 476, "O": 415, "P": 254}
CUT = "1998-01-01"
SPEC = PublishSpec("part", ("o_orderkey",), ("o_orderkey",), ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), ("o_totalprice",))

_LI = f"""li as (select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {", ".join(LINE_ORDER)}) as rn from lineitem) where rn = 1)"""
_KIND = "case o_orderstatus when 'F' then 476 when 'O' then 415 when 'P' then 254 end"


def uuid_sql(expr: str) -> str:
    h = f"md5(cast({expr} as varchar))"
    return f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)||'-'||substr({h},21,12))"


def uuid_of(c: Column) -> Column:
    return S.dashed(F.md5(c.cast("string")))


def query(sql: str) -> Callable:
    """Registers a function under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return datasets.first_line(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,4)")


def kind() -> Column:
    return F.when(F.col("o_orderstatus") == "F", 476).when(F.col("o_orderstatus") == "O", 415).when(F.col("o_orderstatus") == "P", 254)


def double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# ---- datasets, filters, joins, unions

HEADER = SourceSpec("orders", "header", period="o_orderdate", key="o_orderkey")


def detail(how: str, *columns: str) -> SourceSpec:
    return SourceSpec("lineitem", "detail", tuple(ColumnSpec(c) for c in columns), parent=HEADER, on={"o_orderkey": "l_orderkey"}, join=how)


@query("select o_orderkey, o_custkey, o_orderdate, l_linenumber, l_partkey, l_quantity from orders join lineitem on o_orderkey = l_orderkey where o_orderdate between timestamp '1995-01-01' and timestamp '1998-12-31'")
def header_detail_join(spark, sf):
    """JOI-01, PIP-01, FLT-01"""
    tables = {n: t(spark, sf, n) for n in ("orders", "lineitem")}
    return datasets.read_source(tables, detail("INNER JOIN", "o_orderkey", "o_custkey", "o_orderdate", "l_linenumber", "l_partkey", "l_quantity"), "1995-01-01", "1998-12-31")


@query("select o_orderkey, l_linenumber, l_quantity from orders left join lineitem on o_orderkey = l_orderkey")
def header_detail_left(spark, sf):
    """JOI-01"""
    return datasets.read_source({n: t(spark, sf, n) for n in ("orders", "lineitem")}, detail("left outer", "o_orderkey", "l_linenumber", "l_quantity"))


@query(
    "select o_orderkey as doc, 'service' as line_kind, l_linenumber as line_no, l_extendedprice as amount, l_tax as tax from orders join lineitem on o_orderkey = l_orderkey where l_returnflag = 'R' "
    "union all select o_orderkey, 'product', l_linenumber, l_extendedprice, null from orders join lineitem on o_orderkey = l_orderkey where l_returnflag <> 'R'"
)
def union_members(spark, sf):
    """PIP-02, SET-01, PRJ-03, JOI-04, FLT-04"""
    base = (ColumnSpec("doc", "o_orderkey"), ColumnSpec("line_no", "l_linenumber"), ColumnSpec("amount", "l_extendedprice"))
    member = lambda flag, name, *more: SourceSpec("lineitem", "detail", (*base, ColumnSpec("line_kind", expression=f"'{name}'"), *more), where=flag, parent=HEADER, on={"o_orderkey": "l_orderkey"})
    spec = UnionSpec((member("l_returnflag = 'R'", "service", ColumnSpec("tax", "l_tax")), member("l_returnflag <> 'R'", "product")), (("doc", "bigint"), ("line_kind", "string"), ("line_no", "int"), ("amount", "double"), ("tax", "double")))
    return datasets.read_union({n: t(spark, sf, n) for n in ("orders", "lineitem")}, spec)


def register(spark, sf, role):
    li, orders = lines(spark, sf), t(spark, sf, "orders").withColumn("kind", kind())
    moves = li.join(orders.select("o_orderkey", "kind"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("doc"), "kind", F.col("l_linenumber").alias("line_no"), F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("quantity"))
    headers = orders.where("kind in (476, 415)").select("kind", F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("partner"), F.lit(-1.0).alias("quantity"))
    sides = li.join(orders.where("kind in (476, 254)").select("o_orderkey", "kind"), F.col("l_orderkey") == F.col("o_orderkey")).select("kind", F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line_no"), F.lit(0.5).alias("quantity"), F.col("l_partkey").alias("item"))
    return datasets.register_with_documents(moves, headers, sides, key="doc", kind="kind", line="line_no", fields=("quantity", "partner", "item"), role=role)


@query(f"with {_LI} select l_orderkey as doc, {_KIND} as kind, l_linenumber as line_no, coalesce(case when l_quantity > 25 then l_quantity end, case when o_orderstatus in ('F', 'O') then -1.0 end)::double as quantity, case when o_orderstatus in ('F', 'O') then o_custkey end as partner, null::bigint as item from li join orders on l_orderkey = o_orderkey")
def register_with_documents(spark, sf):
    """PIP-03, JOI-02, PRJ-04"""
    return register(spark, sf, "dimension").withColumn("item", F.col("item").cast("bigint"))


@query(f"with {_LI} select l_orderkey as doc, {_KIND} as kind, l_linenumber as line_no, coalesce(case when l_quantity > 25 then l_quantity end, case when o_orderstatus in ('F', 'P') then 0.5 end)::double as quantity, null::bigint as partner, case when o_orderstatus in ('F', 'P') then l_partkey end as item from li join orders on l_orderkey = o_orderkey")
def register_with_lines(spark, sf):
    """JOI-03, PRJ-04"""
    return register(spark, sf, "fact").withColumn("partner", F.col("partner").cast("bigint"))


@query(f"with {_LI} select l_orderkey, l_linenumber, o_custkey as hdr_o_custkey, o_orderpriority as hdr_o_orderpriority, o_orderkey is null as hdr_missing from li left join (select * from orders where o_orderstatus <> 'P') on l_orderkey = o_orderkey")
def denormalised_lines(spark, sf):
    """PRJ-07"""
    headers = t(spark, sf, "orders").where("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "l_orderkey")
    return datasets.denormalise(lines(spark, sf).select("l_orderkey", "l_linenumber"), headers, ["l_orderkey"], ["o_custkey", "o_orderpriority"])


@query("select o_orderkey, o_custkey from orders where o_orderkey in (select distinct user_id * 37 from events where event_type = 'error')")
def key_list_scan(spark, sf):
    """FLT-03, SRC-02"""
    wanted = t(spark, sf, "events").where("event_type = 'error'").select((F.col("user_id") * 37).alias("key"))
    return relational.scan(t(spark, sf, "orders"), key="o_orderkey", keys=wanted).select("o_orderkey", "o_custkey")


@query("select year(o_orderdate) * 100 + month(o_orderdate) as part, count(*) as n from orders where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1996-04-01' group by 1")
def half_open_window(spark, sf):
    """FLT-02, SCL-27, SRC-07, AGG-22"""
    return datasets.in_window(t(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1996-04-01").groupBy(S.partition_key(F.col("o_orderdate")).cast("bigint").alias("part")).agg(F.count("*").alias("n"))


@query(f"with {_LI} select l_orderkey, max(l_linenumber) filter (where l_linenumber = m) as l_linenumber, any_value(l_partkey) filter (where l_linenumber = m) as l_partkey from (select *, min(l_linenumber) over (partition by l_orderkey) as m from li) group by 1")
def header_first_line(spark, sf):
    """WIN-01, SRT-01, PIP-04, PRJ-02"""
    return datasets.extract(lines(spark, sf), (), {}, TargetSpec("header", keys=("l_orderkey",), include=("l_linenumber", "l_partkey"), role="dimension"), ["l_linenumber"])


@query(f"with {_LI} select l_orderkey, coalesce(arg_min(l_suppkey, l_linenumber) filter (where l_suppkey is not null and l_suppkey <> l_orderkey % 100), arg_min(l_suppkey, l_linenumber)) as supplier from li group by 1")
def header_first_non_self(spark, sf):
    """WIN-02"""
    return datasets.first_non_self(lines(spark, sf).withColumn("own", F.col("l_orderkey") % 100), ["l_orderkey"], ["l_linenumber"], "l_suppkey", "own", "supplier")


# ---- totals


@query(f"with {_LI} select o_orderdate::date as day, l_suppkey, sum(l_quantity::decimal(18,4))::double as quantity, sum((case when l_returnflag = 'R' then -1 else 1 end) * l_extendedprice::decimal(18,4))::double as amount, count(*) as n_lines from li join orders on l_orderkey = o_orderkey where o_orderdate between timestamp '1995-01-01' and timestamp '1999-12-31' group by 1, 2")
def sales_daily(spark, sf):
    """AGG-03 over JOI-01, SCL-24: the flagship"""
    spec = SourceSpec("li", "detail", (ColumnSpec("o_orderdate"), ColumnSpec("l_suppkey"), ColumnSpec("quantity", expression="cast(l_quantity as decimal(18,4))"), ColumnSpec("amount", expression="if(l_returnflag = 'R', -1, 1) * cast(l_extendedprice as decimal(18,4))")), parent=HEADER, on={"o_orderkey": "l_orderkey"})
    rows = datasets.read_source({"orders": t(spark, sf, "orders"), "li": lines(spark, sf)}, spec, "1995-01-01", "1999-12-31")
    return double(audit.sales_daily(rows, ["l_suppkey"], "quantity", "amount", "o_orderdate"), "quantity", "amount")


def moves(spark, sf):
    return lines(spark, sf).select("l_suppkey", "l_partkey", (F.col("l_linestatus") != "O").cast("int").alias("kind"), money("l_quantity").alias("quantity"), money("l_extendedprice").alias("amount"), "l_shipdate")


@query(f"with {_LI} select * from (select l_suppkey, l_partkey, sum((case when l_linestatus = 'O' then 1 else -1 end) * l_quantity::decimal(18,4))::double as quantity, sum((case when l_linestatus = 'O' then 1 else -1 end) * l_extendedprice::decimal(18,4))::double as amount, max(l_shipdate) as last_at from li group by 1, 2) where quantity <> 0")
def stock_current(spark, sf):
    """AGG-01: every movement is active"""
    return double(audit.stock_current(moves(spark, sf), ["l_suppkey", "l_partkey"], "kind", "quantity", "amount", "l_shipdate"), "quantity", "amount")


@query(f"with {_LI} select l_shipdate::date as day, l_suppkey, coalesce(sum(l_quantity::decimal(18,4)) filter (where l_linestatus = 'O'), 0)::double as income, coalesce(sum(l_quantity::decimal(18,4)) filter (where l_linestatus <> 'O'), 0)::double as expense, sum((case when l_linestatus = 'O' then 1 else -1 end) * l_quantity::decimal(18,4))::double as net from li group by 1, 2")
def stock_daily(spark, sf):
    """AGG-02"""
    return double(audit.stock_daily(moves(spark, sf), ["l_suppkey"], "kind", "quantity", "l_shipdate"), "income", "expense", "net")


@query("select o_orderdate::date as day, o_orderstatus, count(*) as n_rows, count(distinct o_custkey) as n_customers, sum(o_totalprice::decimal(18,4))::double as amount from orders group by 1, 2")
def daily_by_type(spark, sf):
    """AGG-11, AGG-26, AGG-04"""
    sql = "select to_date(o_orderdate) as day, o_orderstatus, count(*) as n_rows, count(distinct o_custkey) as n_customers, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as amount from {frame} group by 1, 2"
    return datasets.over_frame(t(spark, sf, "orders"), sql)


@query("select user_id, count(*) filter (where event_type = 'purchase') as ok, count(*) filter (where event_type is distinct from 'purchase') as failed, ts::date as day from events group by user_id, ts::date")
def order_outcomes(spark, sf):
    """AGG-23: a missing status is a failure"""
    ok = F.col("event_type").eqNullSafe(F.lit("purchase"))
    return checks.counts_by(t(spark, sf, "events").withColumn("day", F.to_date("ts")), {"ok": ok, "failed": ~ok}, ["user_id", "day"])


@query("select p_partkey, sum(l_extendedprice::decimal(18,4))::double / nullif(sum(l_quantity::decimal(18,4))::double, 0) as price, coalesce(max(l_shipdate), timestamp '1970-01-01') as last_at from part left join lineitem on p_partkey = l_partkey group by 1")
def weighted_price(spark, sf):
    """JOI-17, SCL-24, AGG-14: the right side is aggregated before the join"""
    per = t(spark, sf, "lineitem").groupBy("l_partkey").agg(S.weighted(F.sum(money("l_extendedprice")).cast("double"), F.sum(money("l_quantity")).cast("double")).alias("price"), F.max("l_shipdate").alias("last_at"))
    return t(spark, sf, "part").select("p_partkey").join(per, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", "price", F.coalesce("last_at", F.lit("1970-01-01").cast("timestamp")).alias("last_at"))


# ---- links and keys


@query(f"with {_LI} select l_orderkey, l_linenumber, coalesce(case when l_linenumber % 2 = 0 then l_orderkey + 1000000 end, o_orderkey + 1000000) as order_id from li left join (select * from orders where o_orderdate < timestamp '{CUT}') on l_orderkey = o_orderkey")
def fk_resolve(spark, sf):
    """JOI-05: only missing links are filled"""
    headers = t(spark, sf, "orders").where(F.col("o_orderdate") < CUT).withColumn("id", F.col("o_orderkey") + 1000000)
    li = lines(spark, sf).select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey") + 1000000).alias("order_id"))
    return keys.fill_links(li, headers, {"l_orderkey": "o_orderkey"}, "order_id")


@query(f"with {_LI} select l_orderkey, l_linenumber, case when o_orderkey is not null and l_linenumber % 3 = 0 and o_orderdate >= timestamp '{CUT}' then o_orderkey + 5 when l_linenumber % 3 = 0 then -1 else l_orderkey + 5 end as order_id from li left join orders on l_orderkey = o_orderkey")
def fk_dangling(spark, sf):
    """JOI-06: wrong links of recent headers are set right"""
    headers = t(spark, sf, "orders").withColumn("id", F.col("o_orderkey") + 5)
    li = lines(spark, sf).select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 0, F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey") + 5).alias("order_id"))
    return keys.repair_links(li, headers, {"l_orderkey": "o_orderkey"}, "order_id", F.col("o_orderdate") >= CUT)


@query(f"with {_LI} select l_orderkey, l_linenumber, o_orderkey * 10 as order_id from li left join orders on l_orderkey = o_orderkey")
def late_resolve(spark, sf):
    """JOI-10: links open after the first batch close when the other documents come"""
    orders = t(spark, sf, "orders").withColumn("id", F.col("o_orderkey") * 10)
    li = lines(spark, sf).select("l_orderkey", "l_linenumber", F.lit(None).cast("bigint").alias("order_id"))
    first = keys.fill_links(li, orders.where(F.col("o_orderdate") < CUT), {"l_orderkey": "o_orderkey"}, "order_id")
    return keys.fill_links(first, orders.where(F.col("o_orderdate") >= CUT), {"l_orderkey": "o_orderkey"}, "order_id")


@query("select o_orderkey, coalesce(c_custkey, 0) as customer_id from orders left join (select * from customer where c_nationkey < 20) on o_custkey = c_custkey")
def lookup_default_zero(spark, sf):
    """JOI-07, PRJ-11"""
    dim = t(spark, sf, "customer").where("c_nationkey < 20")
    return keys.resolve(t(spark, sf, "orders").select("o_orderkey", "o_custkey"), dim, {"o_custkey": "c_custkey"}, "customer_id", "c_custkey").drop("o_custkey")


@query(f"select o_orderkey, coalesce(c_custkey, 0) as dim_id, coalesce(case when o_orderstatus = 'F' and o2 is not null then o2 * 7 end, 0) as doc_id from (select *, {uuid_sql('o_custkey')} as g from orders) left join (select c_custkey, {uuid_sql('c_custkey')} as cg from customer where c_nationkey < 20) on g = cg left join (select o_orderkey as o2 from orders where o_orderstatus = 'F') on o2 = o_orderkey")
def packed_ref_resolve(spark, sf):
    """JOI-08, JOI-09, KEY-05, SCL-33, SCL-34: ids of plain and typed references inside JSON"""
    refs = S.pack_refs({"customer": uuid_of(F.col("o_custkey")), "order.uid": uuid_of(F.col("o_orderkey")), "order.type": kind()})
    rows = t(spark, sf, "orders").select("o_orderkey", refs.alias("raw_refs"))
    rows = rows.withColumns({"g": S.ref_uid(F.col("raw_refs"), "customer"), "u": S.ref_uid(F.col("raw_refs"), "order"), "k": S.ref_type(F.col("raw_refs"), "order").cast("int")})
    dim = t(spark, sf, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("id"), uuid_of(F.col("c_custkey")).alias("guid"))
    docs = t(spark, sf, "orders").where("o_orderstatus = 'F'").select((F.col("o_orderkey") * 7).alias("id"), uuid_of(F.col("o_orderkey")).alias("guid"), F.lit(476).alias("code"))
    rows = keys.resolve(keys.resolve(rows, dim, {"g": "guid"}, "dim_id"), docs, {"u": "guid", "k": "code"}, "doc_id")
    return rows.select("o_orderkey", "dim_id", "doc_id")


@query(f"with old as (select g, row_number() over (order by g) as id from (select distinct {uuid_sql('o_custkey')} as g from orders where o_orderdate < timestamp '{CUT}')), fresh as (select distinct {uuid_sql('o_custkey')} as g from orders where o_orderdate >= timestamp '{CUT}' except select g from old) select g as guid, id, false as is_stub from old union all select g, row_number() over (order by g) + (select max(id) from old), true from fresh")
def stable_ids(spark, sf):
    """KEY-01: old ids stay, new keys go on from the largest"""
    orders = t(spark, sf, "orders").withColumn("guid", uuid_of(F.col("o_custkey")))
    empty = spark.createDataFrame([], "guid string, id bigint, is_stub boolean")
    first = staged(keys.issue_ids(empty, orders.where(F.col("o_orderdate") < CUT), ["guid"], stub=F.lit(False)), "registry")
    return keys.issue_ids(first, orders.where(F.col("o_orderdate") >= CUT), ["guid"], stub=F.lit(True))


@query(f"select o_orderkey, {_KIND} as kind, row_number() over (order by o_orderkey, {_KIND}) as id, o_orderdate >= timestamp '{CUT}' as is_stub from orders")
def document_ids(spark, sf):
    """KEY-02: ids by key and type; a stub is cleared when its document comes"""
    docs = t(spark, sf, "orders").withColumn("kind", kind())
    empty = spark.createDataFrame([], "o_orderkey bigint, kind int, id bigint, is_stub boolean")
    registry = keys.issue_ids(empty, docs, ["o_orderkey", "kind"], stub=F.lit(True))
    return keys.clear_stubs(registry, docs.where(F.col("o_orderdate") < CUT), ["o_orderkey", "kind"])


@query("with facts as (select distinct o_orderkey as k, o_orderkey + (case when o_orderkey % 50 = 0 then 1 else 0 end) as id from orders), reg as (select o_orderkey as k, o_orderkey as id from orders where o_orderkey % 7 <> 0) select (select count(*) from facts anti join reg using (k)) as missing, (select count(*) from facts join reg using (k) where facts.id <> reg.id) as other_id, 0::bigint as keys_with_many_ids, 0::bigint as ids_with_many_keys")
def registry_verify(spark, sf):
    """KEY-04"""
    facts = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") + (F.col("o_orderkey") % 50 == 0).cast("int")).alias("id"))
    return keys.verify_registry(facts, t(spark, sf, "orders").where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").alias("id")), ["k"])


@query("select n.n_name as id, r.r_name as category, null::varchar as subcategory1 from nation n join region r on n.n_regionkey = r.r_regionkey union all select r_name, null, null from region union all select c.c_name, r.r_name, n.n_name from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey")
def hierarchy_flatten(spark, sf):
    """KEY-07, JOI-19: region, nation, customer"""
    region, nation = t(spark, sf, "region"), t(spark, sf, "nation")
    n = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    nodes = region.select(F.col("r_name").alias("guid"), F.lit(None).cast("string").alias("parent_guid"), F.col("r_name").alias("name")).union(n.select("n_name", "r_name", "n_name")).union(c.select("c_name", "n_name", "c_name"))
    return hierarchy.flatten(nodes, 2)


@query("select distinct n_name as guid from nation join customer on c_nationkey = n_nationkey where n_nationkey % 2 = 0")
def missing_parents(spark, sf):
    """JOI-18"""
    nation = t(spark, sf, "nation")
    c = t(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_name").alias("guid"), F.col("n_name").alias("parent_guid"))
    return hierarchy.missing_parents(c.union(nation.where("n_nationkey % 2 = 1").select("n_name", F.lit(None).cast("string"))))


# ---- loads

_BASE = f"base as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderdate < timestamp '{CUT}')"
_FRESH = "fresh as (select o_orderkey, o_totalprice + 1 as o_totalprice, o_orderdate from orders where o_orderkey % 5 = 0)"


def base(spark, sf):
    return t(spark, sf, "orders").where(F.col("o_orderdate") < CUT).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def fresh(spark, sf):
    return t(spark, sf, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderdate")


@query(f"with {_BASE}, {_FRESH} select coalesce(b.o_orderkey, f.o_orderkey) as o_orderkey, o_custkey, o_orderstatus, coalesce(f.o_totalprice, b.o_totalprice) as o_totalprice from base b full join fresh f on b.o_orderkey = f.o_orderkey")
def upsert_keys(spark, sf):
    """SNK-02, SNK-03, SNK-06: given columns change, others stay, new keys come"""
    return merge.load(base(spark, sf), fresh(spark, sf).drop("o_orderdate"), "upsert", ["o_orderkey"])


@query(f"with {_LI}, last as (select l_suppkey as k, arg_max(l_quantity, (l_shipdate, l_orderkey, l_linenumber)) as q from li where l_suppkey % 2 = 0 group by 1) select s_suppkey as k, s_name as name, coalesce(q, s_acctbal) as q from supplier left join last on s_suppkey = k")
def upsert_last_wins(spark, sf):
    """SNK-03, WIN-03, WIN-04: of several rows of a key the last in order wins"""
    target = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("q"))
    source = lines(spark, sf).where("l_suppkey % 2 = 0").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("q"), "l_shipdate", "l_orderkey", "l_linenumber")
    return merge.upsert(target, source, ["k"], order=["l_shipdate", "l_orderkey", "l_linenumber"])


@query(f"with {_LI}, src as (select l_orderkey, l_linenumber, -l_quantity as l_quantity from li where l_orderkey % 3 = 0 and l_linenumber = 1) select l_orderkey, l_linenumber, l_quantity from li where l_orderkey not in (select l_orderkey from src) union all select * from src")
def delete_insert(spark, sf):
    """SNK-05, SET-03"""
    target = lines(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity")
    return merge.delete_insert(target, target.where("l_orderkey % 3 = 0 and l_linenumber = 1").withColumn("l_quantity", -F.col("l_quantity")), ["l_orderkey"])


@query(f"with {_BASE} select * from base where o_orderstatus <> 'P' union all select o_orderkey, o_custkey, 'P', 0.0 from base where o_orderkey % 100 = 0")
def replace_where(spark, sf):
    """SNK-04"""
    target = base(spark, sf)
    return merge.replace(target, target.where("o_orderkey % 100 = 0").withColumns({"o_orderstatus": F.lit("P"), "o_totalprice": F.lit(0.0)}), "o_orderstatus = 'P'")


@query(f"with {_BASE}, {_FRESH} select * from base union all select o_orderkey, null, null, o_totalprice from fresh where o_orderkey not in (select o_orderkey from base)")
def insert_missing(spark, sf):
    """SNK-09"""
    return merge.insert_missing(base(spark, sf), fresh(spark, sf).drop("o_orderdate"), ["o_orderkey"])


_HOLES = "t as (select case when o_orderkey % 5 <> 0 then o_orderkey end as k, o_totalprice as v, 'old' as src from orders where o_orderkey % 3 <> 0), s as (select case when o_orderkey % 7 <> 0 then o_orderkey end as k, o_totalprice * 2 as v, 'new' as src from orders where o_orderkey % 2 = 0)"


def with_holes(spark, sf):
    """A target and a source some of whose keys are null."""
    rows, k = t(spark, sf, "orders"), F.col("o_orderkey")
    target = rows.where(k % 3 != 0).select(F.when(k % 5 != 0, k).alias("k"), F.col("o_totalprice").alias("v"), F.lit("old").alias("src"))
    return target, rows.where(k % 2 == 0).select(F.when(k % 7 != 0, k).alias("k"), (F.col("o_totalprice") * 2).alias("v"), F.lit("new").alias("src"))


@query(f"with {_HOLES} select k, v, src from t where k is null or k not in (select k from s where k is not null) union all select k, v, src from s")
def upsert_null_keys(spark, sf):
    """SNK-02, SNK-03, SNK-06: null keys on both sides match nothing, and all of their rows stay"""
    return merge.load(*with_holes(spark, sf), "upsert", ["k"])


@query(f"with {_HOLES} select k, v, src from t union all select k, v, src from s where k is null or k not in (select k from t where k is not null)")
def insert_missing_null_keys(spark, sf):
    """SNK-09: as above"""
    return merge.insert_missing(*with_holes(spark, sf), ["k"])


@query(f"with {_BASE}, src as (select o_orderkey as k, o_totalprice + (case when o_orderkey % 10 = 0 then 1 else 0 end) as v, o_orderdate as m from orders where o_orderkey % 5 = 0) select o_orderkey, o_custkey, o_orderstatus, coalesce(v, o_totalprice) as o_totalprice, coalesce(v is distinct from o_totalprice and v is not null, false) as touched from base left join src on o_orderkey = k")
def update_if_different(spark, sf):
    """SNK-10, SNK-11, STR-22"""
    source = t(spark, sf, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + (F.col("o_orderkey") % 10 == 0).cast("int")).alias("o_totalprice"))
    return merge.update_if_different(base(spark, sf), source, "o_orderkey", ["o_totalprice"])


@query(f"with {_LI} select l_orderkey, l_linenumber from li join orders on l_orderkey = o_orderkey where not (o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01') union all select l_orderkey, l_linenumber from li join orders on l_orderkey = o_orderkey where o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1997-01-01' and o_orderstatus = 'F'")
def reload_period(spark, sf):
    """SNK-16"""
    orders, li = t(spark, sf, "orders"), lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    new = datasets.in_window(orders, "o_orderdate", "1996-01-01", "1997-01-01").where("o_orderstatus = 'F'")
    _, out = merge.reload_period(orders, li, new, li.join(new.select("o_orderkey"), "o_orderkey", "left_semi"), "o_orderkey", "o_orderdate", "1996-01-01", "1997-01-01")
    return out.withColumnRenamed("o_orderkey", "l_orderkey")


# ---- changes


def signalled(spark, sf, **kw):
    ev = t(spark, sf, "events")
    a, b = (ev.where(c).select((F.col("user_id") * 101 % 20000).cast("string").alias("uid"), "ts") for c in ("event_type = 'purchase'", "event_type = 'click'"))
    return changes.signals([(a, "uid", "ts"), (b, "uid", "ts")], **kw)


_SIG = "sig as (select (user_id * 101 % 20000)::varchar as uid, max(ts) as updated_at from events where event_type in ('purchase', 'click') group by 1)"


@query("select (user_id * 101 % 20000)::varchar as uid, max(ts) + interval 5 hour as updated_at from events where event_type in ('purchase', 'click') and ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1")
def signal_union_latest(spark, sf):
    """SRC-12, SET-02, AGG-16, SCL-14"""
    return signalled(spark, sf, start="2024-01-05", end="2024-01-20", zone="Asia/Aqtobe")


@query(f"with {_SIG} select k.uid, s.updated_at from (select distinct o_orderkey::varchar as uid from orders) k left join sig s using (uid)")
def signal_for_all_keys(spark, sf):
    """SRC-13, over every order"""
    return changes.signal_for(t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("uid")), signalled(spark, sf))


@query(f"with {_SIG} select * from sig where updated_at >= timestamp '2024-01-15' and uid not in (select o_orderkey::varchar from orders where o_orderdate < timestamp '{CUT}')")
def tail_pickup(spark, sf):
    """STR-02, JOI-11"""
    return changes.late(signalled(spark, sf), base(spark, sf), "o_orderkey", F.lit("2024-01-15").cast("timestamp"))


@query(f"with {_SIG}, c as (select uid from sig union select '' union select ' ') select uid, case when trim(uid) = '' then 'invalid' when uid in (select o_orderkey::varchar from orders where o_orderkey % 9 = 1) then 'deleted' when uid in (select o_orderkey::varchar from orders) then 'ready' else 'pending' end as state from c")
def classify_changes(spark, sf):
    """STR-03, SET-04, JOI-12"""
    candidates = signalled(spark, sf).select("uid").union(spark.createDataFrame([("",), (" ",)], "uid string"))
    ids = t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("uid"))
    return changes.classify(candidates, ids, ids.where("cast(uid as bigint) % 9 = 1"))


@query("select coalesce((select max(ts) from events where event_type = 'nothing'), (select max(ts) from events), timestamp '1970-01-01') as watermark")
def watermark_chain(spark, sf):
    """AGG-14, AGG-15"""
    ev = t(spark, sf, "events")
    return changes.watermark([(ev.where("event_type = 'nothing'"), "ts"), (ev, "ts")], "1970-01-01")


# ---- fingerprints, patches, checks


def parted(spark, sf):
    return t(spark, sf, "orders").withColumn("part", S.partition_key(F.col("o_orderdate")))


_FP = "count(*) as n, sum(('0x' || substr(md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)), 1, 8))::bigint)::double as checksum, sum(o_totalprice::decimal(18,4))::double as sum_o_totalprice"
_PART = "(year(o_orderdate) * 100 + month(o_orderdate))::int"


def printed(df: DataFrame) -> DataFrame:
    return double(df, "checksum", "sum_o_totalprice").drop("sq_o_totalprice")


@query(f"select {_PART} as part, {_FP} from orders group by 1")
def partition_fingerprint(spark, sf):
    """AGG-05, AGG-06, SCL-30"""
    return printed(fingerprint.fingerprint(parted(spark, sf), SPEC.checksum, SPEC.measures, ["part"]))


@query(f"select o_custkey, {_FP} from orders group by 1")
def document_fingerprint(spark, sf):
    """AGG-07"""
    return printed(fingerprint.fingerprint(t(spark, sf, "orders"), SPEC.checksum, SPEC.measures, ["o_custkey"]))


@query(f"select {_PART} as part, {_FP} from orders group by 1")
def fingerprint_additivity(spark, sf):
    """AGG-08: the sum over disjoint parts is the whole's"""
    rows = parted(spark, sf)
    parts = [fingerprint.fingerprint(rows.where(f"o_orderkey % 3 = {k}"), SPEC.checksum, SPEC.measures, ["part"]) for k in range(3)]
    return printed(fingerprint.add(parts, ["part"]))


_CHANGED = "(o_orderkey % 11 = 0)"
_NEW = f"fresh as (select * replace (o_totalprice * 2 as o_totalprice) from orders where {_CHANGED} and o_orderkey % 2 = 0)"


def change_set(spark, sf):
    """Every eleventh order changed; the odd ones of them vanished, the others have a new price."""
    rows = parted(spark, sf)
    changed = rows.where("o_orderkey % 11 = 0")
    return rows, changed.select("o_orderkey"), changed.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query(f"with {_NEW} select o_orderkey, o_totalprice from orders where not {_CHANGED} union all select o_orderkey, o_totalprice from fresh")
def document_patch(spark, sf):
    """STR-11, SNK-08, SNK-17"""
    return publish.patch(*change_set(spark, sf), SPEC.document).select("o_orderkey", "o_totalprice")


@query("select null::int as part, ''::varchar as metric, 0.0::double as a, 0.0::double as b where false")
def patch_adds_up(spark, sf):
    """STR-11, AGG-08, CHK-03: no partition's patch differs from kept plus fresh"""
    old, changed, new = change_set(spark, sf)
    return double(publish.patch_findings(old, changed, new, publish.patch(old, changed, new, SPEC.document), SPEC), "a", "b")


@query(f"select part, arg_min(reason, k) as reason from (select distinct {_PART} as part, 0 as k, 'hot' as reason from orders where o_orderdate >= timestamp '1998-11-01' union all select {_PART}, 1, 'changed' from orders where o_orderstatus = 'P' and o_orderdate >= timestamp '1996-01-01' union all select {_PART}, 2, 'unequal' from orders where o_orderkey % 1000 = 7) group by 1")
def affected_partitions_all_orders(spark, sf):
    """STR-07, STR-08, JOI-20, over every order: those of a status since a date changed"""
    rows = parted(spark, sf)
    changed = rows.where("o_orderstatus = 'P' and o_orderdate >= '1996-01-01'")
    moved = publish.touched_partitions(rows, changed, changed.where("o_totalprice > 100000"), SPEC)
    other = fingerprint.fingerprint(rows.where("o_orderkey % 1000 <> 7"), SPEC.checksum, SPEC.measures, ["part"])
    unequal = fingerprint.differing_parts(fingerprint.fingerprint(rows, SPEC.checksum, SPEC.measures, ["part"]), other, ["part"])
    return changes.affected_partitions([("hot", relational.partitions(rows.where("o_orderdate >= '1998-11-01'"), "part")), ("changed", moved), ("unequal", unequal)])


@query(f"""with {_NEW}, was as (select {_PART} as part, o_orderkey, o_totalprice::decimal(18,4) as v from orders where not {_CHANGED} union all select {_PART}, o_orderkey, o_totalprice::decimal(18,4) from fresh),
  wrong as (select part, case when part = 199701 then v + 1 else v end as v from was)
select w.part, m.metric, m.a, m.b from (select part, sum(v) as a1, sum(v::decimal(19,4) * v::decimal(19,4)) as a2 from was group by 1) w join (select part, sum(v) as b1, sum(v::decimal(19,4) * v::decimal(19,4)) as b2 from wrong group by 1) x using (part),
  lateral (values ('sum_o_totalprice', a1::double, b1::double), ('sq_o_totalprice', a2::double, b2::double)) m(metric, a, b) where m.a <> m.b""")
def patch_does_not_add_up(spark, sf):
    """STR-11, AGG-08, CHK-03: one partition of a patch has wrong amounts, and is found by its sums"""
    old, changed, new = change_set(spark, sf)
    wrong = publish.patch(old, changed, new, SPEC.document).withColumn("o_totalprice", F.col("o_totalprice") + (F.col("part") == 199701).cast("int"))
    return double(publish.patch_findings(old, changed, new, wrong, SPEC), "a", "b")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(spark, sf):
    """AGG-09, AGG-10"""
    return fingerprint.duplicates(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, l_linenumber, l_partkey from lineitem anti join (select * from orders where o_orderstatus <> 'P') on l_orderkey = o_orderkey")
def orphan_lines(spark, sf):
    """JOI-13, JOI-22"""
    return checks.orphans(t(spark, sf, "lineitem"), t(spark, sf, "orders").where("o_orderstatus <> 'P'"), {"l_orderkey": "o_orderkey"}).select("l_orderkey", "l_linenumber", "l_partkey")


@query("select o_orderkey from orders anti join lineitem on o_orderkey = l_orderkey")
def childless_headers(spark, sf):
    """JOI-13"""
    return checks.childless(t(spark, sf, "orders"), t(spark, sf, "lineitem"), {"l_orderkey": "o_orderkey"}).select("o_orderkey")


@query("select o_orderkey, o_custkey + (case when o_orderkey % 13 = 0 then 1 else 0 end) as natural_key from orders where o_orderkey % 13 = 0")
def mismatched_link(spark, sf):
    """JOI-14"""
    rows = t(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") + (F.col("o_orderkey") % 13 == 0).cast("int")).alias("natural_key"), F.col("o_custkey").alias("link"))
    return checks.mismatched(rows, t(spark, sf, "customer"), "link", "c_custkey", {"natural_key": "c_custkey"}).select("o_orderkey", "natural_key")


@query("select 'zero:l_discount' as \"check\", count(*) filter (where coalesce(l_discount = 0, true)) as bad from lineitem union all select 'empty:l_returnflag', count(*) filter (where coalesce(trim(l_returnflag) = '', true)) from lineitem union all select 'unique:l_orderkey,l_linenumber', coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)")
def extra_checks(spark, sf):
    """CHK-02, SCL-37"""
    return checks.extra_checks(t(spark, sf, "lineitem"), [["l_orderkey", "l_linenumber"]], ["l_discount"], ["l_returnflag"])


_DAY = "select o_orderdate::date as day, sum(o_totalprice::decimal(18,4))::double as amount, count(*) as n from orders where {} group by 1"


@query(f"with a as ({_DAY.format('o_orderkey % 17 <> 0')}), b as ({_DAY.format('o_orderkey % 19 <> 0')}) select coalesce(a.day, b.day) as day, coalesce(a.amount, 0) as amount_a, coalesce(b.amount, 0) as amount_b, coalesce(a.n, 0) as n_a, coalesce(b.n, 0) as n_b, round(coalesce(a.amount, 0) - coalesce(b.amount, 0), 2) as amount_delta, coalesce(a.n, 0) - coalesce(b.n, 0) as n_delta, case when coalesce(a.day, b.day) >= date '2000-12-01' then 'PARTIAL' when abs(coalesce(a.amount, 0) - coalesce(b.amount, 0)) > 0.01 or abs(coalesce(a.n, 0) - coalesce(b.n, 0)) > 0.01 then 'DIFF' else 'OK' end as verdict from a full join b on a.day = b.day")
def daily_recon(spark, sf):
    """CHK-13, JOI-15"""
    per = lambda cond: t(spark, sf, "orders").where(cond).groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).cast("double").alias("amount"), F.count("*").alias("n"))
    out = checks.reconcile(per("o_orderkey % 17 <> 0"), per("o_orderkey % 19 <> 0"), ["day"], ["amount", "n"], open_key=F.col("day") >= F.lit("2000-12-01").cast("date"))
    return out.withColumn("amount_delta", F.round("amount_delta", 2))


@query("select o_orderkey, case when o_orderkey % 23 = 0 then 'new' when o_orderkey % 29 = 0 then 'deleted' else 'changed' end as state from orders where o_orderkey % 23 = 0 or o_orderkey % 29 = 0 or o_orderkey % 31 = 0 and not (o_orderkey % 23 = 0 and o_orderkey % 29 = 0)")
def open_partition_diff(spark, sf):
    """CHK-06, SET-05"""
    rows = t(spark, sf, "orders").where("not (o_orderkey % 23 = 0 and o_orderkey % 29 = 0) or o_orderkey % 667 = 0")
    fp = lambda df: fingerprint.fingerprint(df, SPEC.checksum, SPEC.measures, ["o_orderkey"])
    source = rows.where("o_orderkey % 29 <> 0 or o_orderkey % 23 = 0")
    target = rows.where("o_orderkey % 23 <> 0").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 31 == 0, "changed").otherwise(F.col("o_orderpriority")))
    return fingerprint.open_partition_diff(fp(source), fp(target), ["o_orderkey"])


def cells(spark, sf):
    """Light checks of two sides by month and status, and what the last check said."""
    rows = parted(spark, sf)
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    cell = rows.groupBy("o_orderstatus", "part").agg(F.count("*").alias("a"), F.count_if(F.col("o_orderkey") % 40 != 0).alias("b"))
    before = rows.groupBy("o_orderstatus", "part").agg(F.when(F.col("part") % 2 == 0, F.lit("2024-01-01 11:00:00").cast("timestamp")).alias("since"))
    return checks.reconcile_status(cell, before, ["o_orderstatus", "part"], now)


_CELLS = f"cells as (select o_orderstatus, {_PART} as part, count(*) as a, count(*) filter (where o_orderkey % 40 <> 0) as b from orders group by 1, 2), judged as (select o_orderstatus, part, round(abs(a - b)::double / greatest(abs(a), 1) * 100, 4) as diff_pct, case when a <> b then case when part % 2 = 0 then timestamp '2024-01-01 11:00:00' else timestamp '2024-01-01 12:00:00' end end as since from cells), graded as (select *, case when diff_pct = 0 then 'PASS' when since > timestamp '2024-01-01 11:45:00' then 'WAIT' else 'FAIL' end as status from judged)"


@query(f"with {_CELLS} select * from graded")
def reconcile_status(spark, sf):
    """CHK-10, SCL-32"""
    return cells(spark, sf)


@query(f"with {_CELLS} select (part // 100)::int as year, o_orderstatus, ['PASS', 'WAIT', 'FAIL'][max(case status when 'PASS' then 1 when 'WAIT' then 2 else 3 end)] as status, max(diff_pct) as diff_pct from graded group by 1, 2")
def status_grid(spark, sf):
    """AGG-24"""
    return audit.status_grid(cells(spark, sf).withColumn("year", F.floor(F.col("part") / 100).cast("int")), "year", "o_orderstatus")


# ---- audits


@query("select event_type, count(*) as n, count(*) filter (where json_extract(props, '$.k') is null) as no_k, count(*) filter (where value = 0) as zero, count(*) filter (where ts > timestamp '2024-01-25') as in_future from events group by 1")
def null_profile(spark, sf):
    """AGG-12"""
    return checks.counts_by(t(spark, sf, "events"), {"n": F.lit(True), "no_k": F.get_json_object("props", "$.k").isNull(), "zero": F.col("value") == 0, "in_future": F.col("ts") > "2024-01-25"}, ["event_type"])


@query(" union all ".join(f"select '{c}' as column_name, count(distinct {c}) as n_distinct, round(avg(({c} is null)::int) * 100, 4) as null_pct, round(avg(length({c}::varchar)), 4) as avg_width from customer" for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")))
def column_profile(spark, sf):
    """AGG-27"""
    return audit.column_profile(t(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).drop("n_empty_refs")


_REFS = "select c_custkey, case when c_custkey % 4 = 0 then '00000000-0000-0000-0000-000000000000' when c_custkey % 4 = 1 then null else c_name end as ref from customer"


@query(f"select column_name, round(null_pct, 4) as null_pct, n_empty_refs, true as close from (with r as ({_REFS}) select 'c_custkey' as column_name, 0.0 as null_pct, 0::bigint as n_empty_refs union all select 'ref', avg((ref is null)::int) * 100, count(*) filter (ref = '00000000-0000-0000-0000-000000000000') from r)")
def column_profile_one_scan(spark, sf):
    """AGG-27: distinct values as sketches, and empty references, in one scan; whether the sketches are within 5 per cent of the counts"""
    rows = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.lit("00000000-0000-0000-0000-000000000000")).when(F.col("c_custkey") % 4 != 1, F.col("c_name")).alias("ref"))
    near, exact = (audit.column_profile(rows, ["c_custkey", "ref"], exact=e) for e in (False, True))
    joined = near.join(exact.select("column_name", F.col("n_distinct").alias("d")), "column_name")
    return joined.select("column_name", "null_pct", "n_empty_refs", (F.abs(F.col("n_distinct") - F.col("d")) <= F.col("d") * 0.05).alias("close"))


@query("select l_returnflag, median(l_extendedprice) as middle from lineitem group by 1")
def group_medians(spark, sf):
    """AGG-20: exact medians of large groups, by selection"""
    return audit.medians(t(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query("with d as (select l_shipdate::date as day, count(*) as n from lineitem group by 1) select day, n, (select median(n) from d) as middle from d where n > 1.3 * (select median(n) from d)")
def daily_outliers(spark, sf):
    """WIN-08, AGG-20"""
    return audit.outliers(t(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n")), "n", 1.3)


def runs(spark, sf):
    return t(spark, sf, "events").select(F.col("event_id").alias("run_id"), "user_id", "ts", F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"))


_RUNS = "runs as (select event_id as run_id, user_id, ts, case when event_type = 'error' then 'failed' else 'success' end as status from events)"


@query(f"with {_RUNS}, g as (select user_id, round(epoch_us(ts) / 1e6 - epoch_us(lag(ts) over (partition by user_id order by ts, run_id)) / 1e6, 3) as gap from runs) select user_id, count(gap) as n_gaps, min(gap) as least, round(median(gap), 3) as middle, max(gap) as largest, count(*) filter (where gap > 36000) as n_over from g group by 1")
def run_gaps(spark, sf):
    """WIN-05, AGG-20"""
    return audit.run_gaps(runs(spark, sf), "ts", ["user_id"], 36000)


@query(f"with {_RUNS}, c as (select *, row_number() over (partition by user_id order by ts, run_id) - row_number() over (partition by user_id, status order by ts, run_id) as i from runs) select user_id, status, max(n) as longest from (select user_id, status, i, count(*) as n from c group by 1, 2, 3) group by 1, 2")
def failure_streaks(spark, sf):
    """WIN-06"""
    return audit.streaks(runs(spark, sf), ["user_id"], "ts", "status")


@query(f"with {_RUNS} select user_id, max(ts) filter (where status = 'success') as last_ok, round(epoch_us(timestamp '2024-02-01') / 1e6 - epoch_us(max(ts) filter (where status = 'success')) / 1e6, 3) as lag_s from runs group by 1")
def freshness_rollup(spark, sf):
    """AGG-28"""
    return audit.freshness(runs(spark, sf), "user_id", "ts", F.col("status") == "success", F.lit("2024-02-01").cast("timestamp"))


@query("select hour(ts)::int as hour, event_type, count(*) as n from events group by 1, 2")
def hour_histogram(spark, sf):
    """CHK-20"""
    return t(spark, sf, "events").groupBy(F.hour("ts").alias("hour"), "event_type").agg(F.count("*").alias("n"))


@query("select len(list_filter([10.0, 50.0, 100.0], lambda x: x <= value))::int as bucket, count(*) as n from events where value is not null group by 1")
def span_buckets(spark, sf):
    """SCL-25, AGG-18"""
    return t(spark, sf, "events").where("value is not null").groupBy(S.width_bucket(F.col("value"), [10, 50, 100]).alias("bucket")).agg(F.count("*").alias("n"))


@query("select n_rows, n_versions, count(*) as n_docs from (select l_orderkey, least(count(*), 5) as n_rows, count(distinct l_shipdate) as n_versions from lineitem group by 1) group by 1, 2")
def version_histogram(spark, sf):
    """AGG-18, AGG-19"""
    return audit.version_histogram(t(spark, sf, "lineitem"), "l_orderkey", "l_shipdate")


@query("select user_id, arg_max(event_type, (ts, event_id)) as last_type, count(distinct event_type) as n_types, min(ts) as first_at, max(ts) as last_at from events group by 1")
def latest_by_time(spark, sf):
    """AGG-17, WIN-10, AGG-16"""
    return t(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count_distinct("event_type").alias("n_types"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


@query(f"with {_LI} select l_orderkey, l_linenumber from li join orders on l_orderkey = o_orderkey where o_orderdate >= timestamp '2000-12-31' - interval 400 day and l_shipdate <= o_orderdate + interval 20 day")
def vanished_lines(spark, sf):
    """WIN-07"""
    headers = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return audit.vanished_lines(lines(spark, sf), headers, "l_orderkey", "l_shipdate", "o_orderdate", F.lit("2000-12-31").cast("timestamp"), "INTERVAL -20 DAYS", "INTERVAL 400 DAYS").select("l_orderkey", "l_linenumber")


@query("(select c_custkey, 1 as turn from customer where c_custkey > (select max(c_custkey) - 5 from customer)) union all (select c_custkey, 2 from customer order by c_custkey limit 7)")
def cyclic_queue(spark, sf):
    """WIN-09: 12 rows on from a cursor, round the end"""
    dim = t(spark, sf, "customer")
    top = dim.agg(F.max("c_custkey")).first()[0] or 0
    return audit.next_batch(dim.select("c_custkey"), "c_custkey", top - 5, 12).select("c_custkey", F.when(F.col("c_custkey") > top - 5, 1).otherwise(2).alias("turn"))


@query("select event_id, user_id, ts from events order by ts desc, event_id limit 100")
def latest_changes(spark, sf):
    """SRT-02, SRT-03"""
    return t(spark, sf, "events").orderBy(F.desc("ts"), "event_id").limit(100).select("event_id", "user_id", "ts")


@query("select domain, sum(n)::bigint as n, max(last_at) as last_at from (select 'sales' as domain, count(*) as n, max(o_orderdate) as last_at from orders union all select 'sales', count(*), max(l_shipdate) from lineitem union all select 'web', count(*), max(ts) from events) group by 1")
def domain_rollup(spark, sf):
    """AGG-29"""
    return audit.domain_totals({"o": ("sales", t(spark, sf, "orders"), "o_orderdate"), "l": ("sales", t(spark, sf, "lineitem"), "l_shipdate"), "e": ("web", t(spark, sf, "events"), "ts")})


# ---- scalar functions


@query("select event_id, coalesce(value, 0.0) * 1.12 as with_vat, (case when event_type = 'error' then -1 when event_type = 'purchase' then 1 else 0 end)::int as sign, (case when event_type = 'error' then -1 when event_type = 'purchase' then 1 else 0 end) * coalesce(value, 0.0) as used, case when value <> 0 then 100 / value else 0.0 end as unit_price from events")
def money_measures(spark, sf):
    """SCL-20, SCL-21, SCL-22, SCL-23"""
    names = F.when(F.col("event_type") == "error", "return").when(F.col("event_type") == "purchase", "sale").otherwise(F.col("event_type"))
    sign = S.doc_sign(names, F.lit(""), ("return", "sale", "till"))
    return t(spark, sf, "events").select("event_id", S.sales_with_vat(F.col("value"), F.lit(0)).alias("with_vat"), sign.alias("sign"), S.signed(F.col("value"), sign).alias("used"), S.ratio(F.lit(100), F.col("value")).alias("unit_price"))


@query("select o_orderkey, (substr(h,25,8)||'-'||substr(h,21,4)||'-'||substr(h,17,4)||'-'||substr(h,1,4)||'-'||substr(h,5,12)) as guid, upper(h) as back, '0x'||upper(h) as shown from (select o_orderkey, md5(o_orderkey::varchar) as h from orders)")
def uuid_decode(spark, sf):
    """SCL-01, SCL-02, SCL-03, SCL-08"""
    b = F.unhex(F.md5(F.col("o_orderkey").cast("string")))
    return t(spark, sf, "orders").select("o_orderkey", S.binary_auto(b).alias("guid"), F.hex(S.uuid_to_binary(S.binary_to_uuid(b))).alias("back"), S.binary_to_hex(b).alias("shown"))


@query(f"select c_custkey, {uuid_sql('c_custkey')} as parsed, case when c_custkey % 10 <> 0 then {uuid_sql('c_custkey')} end as normal from customer")
def lenient_uuid(spark, sf):
    """SCL-04, SCL-05"""
    messy = F.concat(F.lit(" 0x"), F.upper(F.md5(F.col("c_custkey").cast("string"))), F.lit(" "))
    return t(spark, sf, "customer").select("c_custkey", S.parse_uuid(messy).alias("parsed"), S.norm_key(F.when(F.col("c_custkey") % 10 == 0, F.lit(S.ZERO_UUID)).otherwise(messy)).alias("normal"))


@query("select o_orderkey, o_orderdate as fixed, strftime(o_orderdate, '%Y-%m-%d') as fixed_text from orders")
def fix_year(spark, sf):
    """SCL-11, SCL-12: dates kept 2000 years ahead"""
    far = F.add_months("o_orderdate", 24000).cast("timestamp")
    return t(spark, sf, "orders").select("o_orderkey", S.fix_year(far).alias("fixed"), S.fix_year_text(F.date_format(far, "yyyy-MM-dd")).alias("fixed_text"))


@query("select event_id, json_extract_string(props, '$.k')::bigint as k, event_id % 3 = 0 as flag, (event_id % 100)::double / 8 as eighth from events")
def lenient_casts(spark, sf):
    """SCL-15, SCL-16, SCL-17, SCL-18, SCL-34"""
    word = F.element_at(F.array(F.lit(" Да "), F.lit("no"), F.lit("F")), (F.col("event_id") % 3 + 1).cast("int"))
    return t(spark, sf, "events").select("event_id", S.to_int(F.get_json_object("props", "$.k")).alias("k"), S.cast(word, "bool").alias("flag"), S.to_decimal((F.col("event_id") % 100).cast("double") / 8, 3).cast("double").alias("eighth"))


@query(f"select o_orderkey, '{{\"customer\":\"' || {uuid_sql('o_custkey')} || '\"' || case when o_orderstatus = 'F' then ',\"order\":{{\"uid\":\"' || {uuid_sql('o_orderkey')} || '\",\"type\":\"476\"}}' else '' end || '}}' as raw_refs, {uuid_sql('o_custkey')} as customer from orders")
def json_pack(spark, sf):
    """SCL-33, SCL-34: unset parts and nested objects without uid are left out"""
    refs = S.pack_refs({"customer": uuid_of(F.col("o_custkey")), "none": F.lit(S.ZERO_UUID), "order.uid": F.when(F.col("o_orderstatus") == "F", uuid_of(F.col("o_orderkey"))), "order.type": kind()})
    return t(spark, sf, "orders").select("o_orderkey", refs.alias("raw_refs")).withColumn("customer", S.ref_uid(F.col("raw_refs"), "customer"))


@query(f"select {_PART} as part, (date_trunc('month', min(o_orderdate)))::date as first_day, (date_trunc('month', min(o_orderdate)) + interval 1 month)::date as end_day from orders group by 1")
def partition_bounds(spark, sf):
    """SCL-27, SCL-28"""
    return relational.partitions(parted(spark, sf), "part").select("part", S.partition_start(F.col("part")).alias("first_day"), S.partition_end(F.col("part")).alias("end_day"))


@query("select s_suppkey, coalesce(s_acctbal, 0)::double as balance, coalesce(trim(s_name), '') as name, 0::bigint as missing, timestamp '1970-01-01' as no_time from supplier")
def typed_defaults(spark, sf):
    """PRJ-08, PRJ-09"""
    nothing = F.lit(None).cast("string")
    return t(spark, sf, "supplier").select("s_suppkey", S.typed(S.finite(F.col("s_acctbal")), "double").alias("balance"), S.typed(F.trim("s_name"), "string").alias("name"), S.typed(nothing, "bigint").alias("missing"), S.typed(nothing, "timestamp").alias("no_time"))


# ---- dimensions, modes, reports

_DIM = "dim as (select c_custkey as guid, c_custkey * 2 as id, case when c_custkey % 5 <> 0 then c_name end as name, c_custkey % 5 = 0 as is_stub, case when c_custkey % 5 <> 0 then timestamp '2024-01-01' end as marked_at from customer where c_custkey % 4 <> 0), src as (select c_custkey as guid, c_name || '!' as name, case when c_custkey % 3 = 0 then timestamp '2024-02-01' else timestamp '2023-12-01' end as marked_at from customer)"


def dim_frames(spark, sf):
    c = t(spark, sf, "customer")
    at = lambda s: F.lit(s).cast("timestamp")
    known = F.col("c_custkey") % 5 != 0
    dim = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("guid"), (F.col("c_custkey") * 2).alias("id"), F.when(known, F.col("c_name")).alias("name"), (~known).alias("is_stub"), F.when(known, at("2024-01-01")).alias("marked_at"))
    return dim, c.select(F.col("c_custkey").alias("guid"), F.concat("c_name", F.lit("!")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, at("2024-02-01")).otherwise(at("2023-12-01")).alias("marked_at"))


@query(f"with {_DIM}, changed as (select * from src where marked_at > (select max(marked_at) from dim)) select d.guid, id, coalesce(c.name, d.name) as name, is_stub and c.guid is null as is_stub, coalesce(c.marked_at, d.marked_at) as marked_at from dim d left join changed c on c.guid = d.guid union all select guid, row_number() over (order by guid) + (select max(id) from dim), name, false, marked_at from changed where guid not in (select guid from dim)")
def dimension_incremental(spark, sf):
    """STR-16"""
    dim, source = dim_frames(spark, sf)
    return dimensions.incremental(dim, source, "guid", ["name"], "marked_at")


@query(f"with {_DIM}, queue as (select guid from dim where is_stub order by case when id > 100 then 0 else 1 end, id limit 50) select guid, id, case when guid in (select guid from queue) then guid::varchar || '?' else name end as name, is_stub and guid not in (select guid from queue) as is_stub, marked_at from dim")
def stub_pass(spark, sf):
    """STR-17, STR-22, WIN-09, SCL-39"""
    dim, source = dim_frames(spark, sf)
    return dimensions.stub_pass(dim, source.withColumn("name", F.concat(F.col("guid").cast("string"), F.lit("?"))), "guid", ["name"], ["name"], 100, 50)


@query("select user_id, hour(last_at)::int as hour, case when last_at >= date_trunc('day', last_at) + interval 3 hour and coalesce(swept, timestamp '1970-01-01') < date_trunc('day', last_at) + interval 3 hour then 'sweep' when coalesce(hot, timestamp '1970-01-01') <= last_at - interval 1 hour then 'hot' else 'patch' end as mode from (select user_id, max(ts) as last_at, max(ts) filter (where event_type = 'view') as swept, max(ts) filter (where event_type = 'click') as hot from events group by 1)")
def due_modes(spark, sf):
    """STR-10"""
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts"))).cast("timestamp")
    per = t(spark, sf, "events").groupBy("user_id").agg(F.max("ts").cast("timestamp").alias("last_at"), last("view").alias("swept"), last("click").alias("hot"))
    return per.select("user_id", F.hour("last_at").alias("hour"), publish.due_mode(F.col("swept"), F.col("hot"), F.col("last_at")).alias("mode"))


@query("with d as (select o_orderkey from orders where o_orderkey % 50 <> 0) select 'orders' as name, (select count(*) from orders) as n_source, (select count(*) from d) as n_target, 0::bigint as n_duplicate, case when (select count(*) from orders) = (select count(*) from d) then 'OK' else 'DIFF' end as verdict union all select 'lineitem', count(*), count(*), (select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from lineitem group by l_orderkey, l_linenumber having count(*) > 1)), 'DUPLICATES' from lineitem")
def summary_report(spark, sf):
    """CHK-12"""
    orders, li = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    return checks.summary({"orders": (orders, orders.where("o_orderkey % 50 <> 0"), ["o_orderkey"]), "lineitem": (li, li, ["l_orderkey", "l_linenumber"])})


@query("select c_custkey from customer where c_custkey % 6 <> 1 except select c_custkey from customer where c_custkey % 3 <> 0")
def vanished_references(spark, sf):
    """SET-07, SET-05"""
    c = t(spark, sf, "customer").select("c_custkey")
    return dimensions.vanished(c.where("c_custkey % 6 <> 1"), c.where("c_custkey % 3 <> 0"), "c_custkey")


from tallyloom import load_queries  # noqa: E402, F401 - registers its queries here
