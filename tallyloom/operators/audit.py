"""Audit roll-ups: stock and sales totals, profiles, freshness, run history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalars import binary_to_int, checkpoint_field, deviation, safe_sum
from tallyloom.staged import staged

#: Severity of a reconciliation status.
SEVERITY = {"PASS": 0, "WAIT": 1, "FAIL": 2}


def stock_current(moves: DataFrame, keys: Sequence[str], kind: str, quantity: str, amount: str, at: str, active: Column | None = None) -> DataFrame:
    """Signed totals by key (kind 0 in, else out) of movements that are ``active``; keys of quantity 0 are left out [AGG-01, FLT-06]."""
    if active is not None:
        moves = moves.where(active)
    sign = F.when(F.col(kind) == 0, F.lit(1)).otherwise(F.lit(-1))
    return moves.groupBy(*keys).agg(F.sum(sign * F.col(quantity)).alias("quantity"), F.sum(sign * F.col(amount)).alias("amount"), F.max(at).alias("last_at")).where("quantity <> 0")


def stock_daily(moves: DataFrame, keys: Sequence[str], kind: str, quantity: str, at: str) -> DataFrame:
    """Income, expense and net by day and key [AGG-02]."""
    income, expense = F.sum(F.when(F.col(kind) == 0, F.col(quantity)).otherwise(0)), F.sum(F.when(F.col(kind) != 0, F.col(quantity)).otherwise(0))
    return moves.groupBy(F.to_date(at).alias("day"), *keys).agg(income.alias("income"), expense.alias("expense"), (income - expense).alias("net"))


def sales_daily(lines: DataFrame, keys: Sequence[str], quantity: str, amount: str, at: str) -> DataFrame:
    """Quantity, amount and lines by day and key [AGG-03]."""
    return lines.groupBy(F.to_date(at).alias("day"), *keys).agg(F.sum(quantity).alias("quantity"), F.sum(amount).alias("amount"), F.count("*").alias("n_lines"))


#: Fixed value: what an empty reference comes to without its dashes.
NO_REFERENCE = "0" * 32


def column_profile(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(column_name, n_distinct, null_pct, avg_width, n_empty_refs) [AGG-27].

    Shares, widths and empty references come from one scan, and so do the distinct values as sketches
    that merge (within about 2 per cent).  ``exact`` counts them instead, column by column, so no row is
    multiplied by the columns.
    """
    text = lambda c: F.col(c).cast("string")
    aggs = [a for k, c in enumerate(columns) for a in (F.avg(F.col(c).isNull().cast("int")).alias(f"n{k}"), F.avg(F.length(text(c))).alias(f"w{k}"), F.count_if(F.replace(text(c), F.lit("-"), F.lit("")) == NO_REFERENCE).alias(f"e{k}"))]
    if not exact:
        aggs += [F.hll_sketch_estimate(F.hll_sketch_agg(text(c), F.lit(14))).alias(f"d{k}") for k, c in enumerate(columns)]
    one = df.agg(*aggs)
    if exact:
        for k, c in enumerate(columns):
            one = one.join(df.select(F.col(c).alias("__v")).where("__v is not null").groupBy("__v").agg(F.lit(1).alias("__n")).agg(F.count("*").alias(f"d{k}")))  # one row each
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"d{k}").alias("n_distinct"), F.round(F.col(f"n{k}") * 100, 4).alias("null_pct"), F.round(f"w{k}", 4).alias("avg_width"), F.col(f"e{k}").alias("n_empty_refs")) for k, c in enumerate(columns)])
    return one.select(F.explode(rows).alias("x")).select("x.*")


#: Values of a group that are brought together at last, and the grid and the size of a selection's sketches.
FEW, GRID, ACCURACY = 20_000, 256, 8192


def medians(df: DataFrame, measure: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, middle): the exact median of each group, of any size [AGG-20, WIN-08].

    A selection by rounds: quantile sketches, which merge, propose two values about the wanted place; counting
    what is below and up to them says whether one of them is it, and if not, between which bounds it lies
    and at which place there.  A round leaves about one value in a hundred, and always fewer than
    before; groups of ``FEW`` or less are sorted.  Nulls do not count; a group without values has no row.
    """
    keys = [f"__k{k}" for k in range(len(by))] or ["__k"]
    renamed = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("__k")]
    values = df.select(*renamed, F.col(measure).cast("double").alias("v")).where("v is not null")

    def inside(state: DataFrame) -> DataFrame:
        side = state.withColumnsRenamed({k: f"{k}_" for k in keys})
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
        within = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") < F.col("hi")))
        return values.join(side, same).where(within)

    counts = values.groupBy(*keys).agg(F.count("*").alias("n"))
    no_bound = F.lit(None).cast("double")
    # the two middle places, which are one where n is odd, counted from 0 among the values between lo and hi
    places = F.explode(F.array_distinct(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2")))).alias("place")
    state = staged(counts.select(*keys, "n", places).select(*keys, F.col("place").alias("which"), "n", "place", no_bound.alias("lo"), no_bound.alias("hi")), "median-state")
    own, small, found = [*keys, "which"], [], []
    while True:
        small.append(state.where(F.col("n") <= FEW))
        state = state.where(F.col("n") > FEW)
        if state.isEmpty():
            break
        grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
        cut = inside(state).groupBy(*own, "n", "place", "lo", "hi").agg(F.percentile_approx("v", grid, F.lit(ACCURACY)).alias("g"))
        at = lambda more: F.element_at("g", F.least(F.lit(GRID), F.floor(F.col("place") / F.col("n") * GRID) + more).cast("int") + 1)
        asked = staged(cut.select(*own, "n", "place", "lo", "hi", at(0).alias("l"), at(1).alias("h")), "median-asked")
        sums = [F.count_if(F.col("v") < F.col("l")).alias("less_l"), F.count_if(F.col("v") <= F.col("l")).alias("to_l"), F.count_if(F.col("v") < F.col("h")).alias("less_h"), F.count_if(F.col("v") <= F.col("h")).alias("to_h")]
        seen = staged(inside(asked).groupBy(*own, "n", "place", "lo", "hi", "l", "h").agg(*sums), "median-seen")
        is_l, is_h = (F.expr(f"place >= less_{x} and place < to_{x}") for x in "lh")
        found.append(seen.where(is_l | is_h).select(*own, F.when(is_l, F.col("l")).otherwise(F.col("h")).alias("v")))
        under, over = F.col("place") < F.col("less_l"), F.col("place") >= F.col("to_h")
        three = lambda a, b, c: F.when(under, a).when(over, b).otherwise(c)
        state = seen.where(~is_l & ~is_h).select(
            *own, three(F.col("less_l"), F.col("n") - F.col("to_h"), F.col("less_h") - F.col("to_l")).alias("n"), (F.col("place") - three(F.lit(0), F.col("to_h"), F.col("to_l"))).alias("place"),
            three(F.col("lo"), F.col("h"), F.col("l")).alias("lo"), three(F.col("l"), F.col("hi"), F.col("h")).alias("hi"),
        )
        state = staged(state, "median-state")
    last = inside(staged(reduce(DataFrame.unionByName, small), "median-small")).groupBy(*own, "place").agg(F.sort_array(F.collect_list("v")).alias("a"))  # FEW at most
    picked = reduce(DataFrame.unionByName, [*found, last.select(*own, F.element_at("a", F.col("place").cast("int") + 1).alias("v"))])
    out = picked.groupBy(*keys).agg(F.avg("v").alias("middle"))
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "middle")


def in_parts(runs: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """``runs`` with ``__part``, a range of their order: a key's runs lie in as many parts as they fill."""
    order = [*by, at, "run_id"]
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(runs.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "run-parts")


def gaps(runs: DataFrame, at: str, by: Sequence[str]) -> DataFrame:
    """(by, gap): seconds from each run to the next.  Parts are walked on their own; a part's first run takes the last of the part before."""
    rows = in_parts(runs, by, at)
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    inside = Window.partitionBy(*by, "__part").orderBy(at, "run_id")
    within = rows.select(*by, F.round(seconds(at) - F.lag(seconds(at)).over(inside), 3).alias("gap"))
    ends = rows.groupBy(*by, "__part").agg(F.min(at).alias("__first"), F.max(at).alias("__last"))  # a row a key and part
    across = ends.select(*by, F.round(seconds("__first") - F.lag(seconds("__last")).over(Window.partitionBy(*by).orderBy("__part")), 3).alias("gap"))
    return within.unionByName(across).where("gap is not null")


def run_gaps(runs: DataFrame, at: str, by: Sequence[str], over_s: float) -> DataFrame:
    """Gaps between runs: number, least, median, largest, and how many exceed a limit [WIN-05, AGG-20, CHK-19]."""
    each = staged(gaps(runs, at, by), "gaps")
    had = runs.select(*by).distinct()
    sums = each.groupBy(*by).agg(F.count("gap").alias("n_gaps"), F.min("gap").alias("least"), F.max("gap").alias("largest"), F.count_if(F.col("gap") > over_s).alias("n_over"))
    joined = _beside(_beside(had, sums, by), medians(each, "gap", by), by)
    return joined.select(*by, F.coalesce("n_gaps", F.lit(0)).alias("n_gaps"), "least", F.round("middle", 3).alias("middle"), "largest", F.coalesce("n_over", F.lit(0)).alias("n_over"))


def _beside(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """A left join on ``by``, in which null keys are equal."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in by})
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in by], F.lit(True))
    return left.join(renamed, on, "left").drop(*[f"__r_{c}" for c in by])


def streaks(runs: DataFrame, by: Sequence[str], at: str, status: str) -> DataFrame:
    """The longest run of each status in a row [WIN-06].

    Each part of the order sums up its runs of equal status.  Only the first and the last of a part can go
    on in another, so these are joined once more, part by part.
    """
    inside = Window.partitionBy(*by, "__part").orderBy(at, "run_id")
    change = (~F.col(status).eqNullSafe(F.lag(status).over(inside)) | F.lag("run_id").over(inside).isNull()).cast("int")
    islands = in_parts(runs, by, at).withColumn("__c", change).withColumn("__i", F.sum("__c").over(inside)).groupBy(*by, "__part", "__i", status).agg(F.count("*").alias("n"))
    islands = staged(islands.withColumn("__top", F.max("__i").over(Window.partitionBy(*by, "__part"))), "islands")
    edges = islands.where("__i = 1 or __i = __top")  # two a key and part at most
    order = Window.partitionBy(*by).orderBy("__part", "__i")
    fresh = (~F.col(status).eqNullSafe(F.lag(status).over(order)) | F.lag("__part").over(order).isNull() | (F.lag("__part").over(order) == F.col("__part"))).cast("int")
    joined = edges.withColumn("__f", fresh).withColumn("__j", F.sum("__f").over(order)).groupBy(*by, status, "__j").agg(F.sum("n").alias("n"))
    return islands.where("__i > 1 and __i < __top").select(*by, status, "n").unionByName(joined.select(*by, status, "n")).groupBy(*by, status).agg(F.max("n").alias("longest"))


def vanished_lines(lines: DataFrame, headers: DataFrame, key: str, stamp: str, touched: str, now: Column, older: str = "INTERVAL 30 MINUTES", recent: str = "INTERVAL 60 MINUTES") -> DataFrame:
    """Lines that the last load of their document did not touch [WIN-07]."""
    side = headers.select(F.col(key).alias("__key"), F.col(touched).alias("__at"))
    return lines.join(side, F.col(key) == F.col("__key")).where(is_vanished(F.col(stamp), F.col("__at"), now, older, recent)).select(*lines.columns)


def is_vanished(stamp: Column, touched: Column, now: Column, older: str, recent: str) -> Column:
    """The document was loaded within ``recent``, and the line's stamp is ``older`` than that load."""
    return (touched >= now - F.expr(recent)) & (stamp <= touched - F.expr(older))


def outliers(daily: DataFrame, measure: str, times: float = 3.0) -> DataFrame:
    """Rows beyond ``times`` the median of all [WIN-08]."""
    return daily.join(medians(daily, measure)).where(F.col(measure) > times * F.col("middle"))  # one row


def next_batch(queue: DataFrame, id_col: str, cursor: int, n: int) -> DataFrame:
    """The next ``n`` rows by id after the cursor, going on from the start when they run out [WIN-09]."""
    order = F.when(F.col(id_col) > cursor, 0).otherwise(1)
    return queue.orderBy(order, id_col).limit(n)


def status_grid(cells: DataFrame, row: str, column: str) -> DataFrame:
    """Worst status and largest deviation of each cell [AGG-24]."""
    rank = F.try_element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), F.col("status"))
    worst = F.try_element_at(F.create_map(*[F.lit(x) for k, v in SEVERITY.items() for x in (v, k)]), F.max(rank))
    return cells.groupBy(row, column).agg(worst.alias("status"), F.max("diff_pct").alias("diff_pct"))


def freshness(runs: DataFrame, target: str, at: str, ok: Column, now: Column) -> DataFrame:
    """Last success of each target and its lag in seconds [AGG-28, CHK-18]."""
    last = F.max(F.when(ok, F.col(at)))
    return runs.groupBy(target).agg(last.alias("last_ok")).withColumn("lag_s", F.round(F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(F.col("last_ok").cast("timestamp")) / 1e6, 3))


def lags(source: DataFrame, source_at: str, data: DataFrame, data_at: str, runs: DataFrame, run_at: str, now: Column) -> DataFrame:
    """One row: seconds since the last signal, the last loaded row and the last run [CHK-18]."""
    parts = [df.agg(F.round(F.unix_micros(now.cast("timestamp")) / 1e6 - F.unix_micros(F.max(at).cast("timestamp")) / 1e6, 3).alias(name)) for df, at, name in ((source, source_at, "source_s"), (data, data_at, "data_s"), (runs, run_at, "pipeline_s"))]
    return parts[0].join(parts[1]).join(parts[2])  # one row each


def backlog(signalled: DataFrame, warehouse: DataFrame, key: str, watermark: Column) -> DataFrame:
    """(scanned, present, n): signals before and after the watermark, by whether the warehouse has their key [CHK-18]."""
    had = warehouse.select(F.col(key).cast("string").alias("__uid")).distinct()
    joined = signalled.join(had, F.col("uid") == F.col("__uid"), "left")
    return joined.groupBy((F.col("updated_at") < watermark).alias("scanned"), F.col("__uid").isNotNull().alias("present")).agg(F.count("*").alias("n"))


def run_windows(runs: DataFrame, checkpoint: str, begin: str = "from", end: str = "to") -> DataFrame:
    """(hour, n_runs, least, largest, mean) of the minutes that runs' windows span, read from their checkpoint text [CHK-19]."""
    at = {name: checkpoint_field(F.col(checkpoint), name).try_cast("timestamp") for name in (begin, end)}
    minutes = (F.unix_micros(at[end]) - F.unix_micros(at[begin])) / 60e6
    return runs.select(F.hour(at[end]).alias("hour"), minutes.alias("m")).where("m is not null").groupBy("hour").agg(F.count("*").alias("n_runs"), F.round(F.min("m"), 3).alias("least"), F.round(F.max("m"), 3).alias("largest"), F.round(F.avg("m"), 3).alias("mean"))


def delta_classes(rows: DataFrame, early: str, later: str, bounds: Mapping[str, tuple[str, str]], other: str = "other") -> DataFrame:
    """(class, n, least, largest) of the seconds between two times; a class spans [from, to) intervals, the first that fits counts [AGG-21]."""
    seconds = F.unix_micros(F.col(later).cast("timestamp")) / 1e6 - F.unix_micros(F.col(early).cast("timestamp")) / 1e6
    label = None
    for name, (low, high) in bounds.items():
        begin, end = (F.col(early).cast("timestamp") + F.expr(f"INTERVAL {x}") for x in (low, high))
        fits = (F.col(later) >= begin) & (F.col(later) < end)
        label = F.when(fits, name) if label is None else label.when(fits, name)
    spans = rows.where(F.col(early).isNotNull() & F.col(later).isNotNull()).select((label.otherwise(other) if label is not None else F.lit(other)).alias("class"), F.round(seconds, 3).alias("s"))
    return spans.groupBy("class").agg(F.count("*").alias("n"), F.min("s").alias("least"), F.max("s").alias("largest"))


def type_audit(rows: DataFrame, by: str, doc: str, measures: Sequence[str], inactive: Column) -> DataFrame:
    """By type: documents, rows, sums without NaN, how many NaN, and the share of inactive rows in per cent [CHK-15, AGG-13]."""
    sums = [a for m in measures for a in (safe_sum(F.col(m)).alias(f"sum_{m}"), F.count_if(F.isnan(m)).alias(f"nan_{m}"))]
    return rows.groupBy(by).agg(F.count_distinct(doc).alias("n_docs"), F.count("*").alias("n_rows"), *sums, F.round(F.count_if(inactive) * 100.0 / F.count("*"), 4).alias("inactive_pct"))


def null_by_parent(rows: DataFrame, by: str, bad: Column, parent_bad: Column) -> DataFrame:
    """By type: rows with a missing value, and how many of them and of the others have a parent that lacks its own [CHK-16]."""
    return rows.groupBy(by).agg(F.count_if(bad).alias("n_bad"), F.count_if(bad & parent_bad).alias("n_bad_parent_bad"), F.count_if(~bad & parent_bad).alias("n_fine_parent_bad"), F.count("*").alias("n_rows"))


def inversions(rows: DataFrame, early: str, later: str, now: Column, by: Sequence[str] = ()) -> DataFrame:
    """How many rows have a later time before the earlier one, or a time yet to come [CHK-17]."""
    return rows.groupBy(*by).agg(F.count_if(F.col(later) < F.col(early)).alias("n_inverted"), F.count_if((F.col(early) > now) | (F.col(later) > now)).alias("n_future"))


def light_check(a: DataFrame, b: DataFrame, month: Column, measures: Mapping[str, str]) -> DataFrame:
    """(month, sums and rows of both sides, deviation in per cent of the worst) of two sides of a register [AGG-25]."""
    one = lambda df, side: df.groupBy(month.alias(f"m_{side}")).agg(F.count("*").alias(f"n_{side}"), *[F.sum(F.col(c).cast("decimal(18,4)")).alias(f"{n}_{side}") for n, c in measures.items()])
    both = one(a, "a").join(one(b, "b"), F.col("m_a").eqNullSafe(F.col("m_b")), "full_outer")
    filled = both.select(F.coalesce("m_a", "m_b").alias("month"), *[F.coalesce(F.col(f"{n}_{s}"), F.lit(0)).alias(f"{n}_{s}") for n in ("n", *measures) for s in "ab"])
    return filled.withColumn("worst_pct", F.greatest(*[deviation(F.col(f"{n}_a"), F.col(f"{n}_b")) for n in ("n", *measures)], F.lit(0.0)))


def snapshot_changes(costs: DataFrame, keys: Sequence[str], day: str, cost: str, days: Sequence[int] = (7, 30), significant: float = 1.0) -> DataFrame:
    """Each key's cost of a day beside its snapshot before and those of so many days ago, with the change in per cent where it is significant [WIN-11].

    Keys include the type of cost, so types are never mixed.  A snapshot that is missing gives null.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    out = costs.select(*keys, day, cost).withColumn("previous", F.lag(cost).over(w))
    for n in days:
        side = costs.select(*[F.col(k).alias(f"__{k}") for k in keys], F.date_add(day, n).alias("__day"), F.col(cost).alias(f"ago_{n}"))
        out = out.join(side, [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col(day) == F.col("__day")], "left").drop(*[f"__{k}" for k in keys], "__day")
    change = lambda c: F.round((F.col(cost) - F.col(c)) / F.nullif(F.abs(F.col(c)), F.lit(0)) * 100, 4)
    return out.select("*", *[F.when(F.abs(change(c)) >= significant, change(c)).alias(f"{c}_pct") for c in ("previous", *[f"ago_{n}" for n in days])])


def types_of(rows: DataFrame, code: str) -> DataFrame:
    """The catalogue of document types in a register: distinct codes, from four bytes or numbers [AGG-30]."""
    value = binary_to_int(F.col(code)) if dict(rows.dtypes)[code] == "binary" else F.col(code).cast("long")
    return rows.select(value.alias("code")).distinct()


def version_histogram(rows: DataFrame, doc: str, at: str, cap: int = 5) -> DataFrame:
    """Documents by number of rows, capped, and number of versions [AGG-18, AGG-19]."""
    per = rows.groupBy(doc).agg(F.least(F.count("*"), F.lit(cap)).alias("n_rows"), F.count_distinct(at).alias("n_versions"))
    return per.groupBy("n_rows", "n_versions").agg(F.count("*").alias("n_docs"))


def domain_totals(tables: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows and last change by domain, from name -> (domain, table, time column) [AGG-29]."""
    frames = [df.agg(F.lit(domain).alias("domain"), F.count("*").alias("n"), F.max(at).alias("last_at")) for domain, df, at in tables.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.groupBy("domain").agg(F.sum("n").alias("n"), F.max("last_at").alias("last_at"))
