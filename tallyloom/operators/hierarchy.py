"""Parent-child trees: ancestors flattened to levels, and missing parents fetched."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.staged import staged


def ancestors(nodes: DataFrame, id_col: str = "guid", parent: str = "parent_guid", name: str = "name") -> DataFrame:
    """(id, ancestor, ancestor_name, distance), the node itself left out [JOI-19].

    Walks double: who is known up to 2**k steps up, and where those steps end, gives all up to
    2**(k + 1), so rounds grow with the logarithm of the depth.  A node has one parent, so each round
    adds as many rows as it finds ancestors.  A walk that returns to a node it has seen ends there,
    as the nearer distance is kept.  Nodes without an id, and parents that are not there, are no ancestors.
    """
    known = nodes.select(F.col(id_col).alias("id"), F.col(parent).alias("ancestor")).where("id is not null")
    there = known.select(F.col("id").alias("ancestor"))
    pairs = staged(known.join(there, "ancestor", "left_semi").where("id <> ancestor").select("id", "ancestor", F.lit(1).cast("long").alias("distance")), "ancestors")
    reach = 1
    while not (ends := pairs.where(F.col("distance") == reach)).isEmpty():
        on = pairs.select(F.col("id").alias("__from"), F.col("ancestor").alias("__to"), F.col("distance").alias("__more"))
        further = ends.join(on, F.col("ancestor") == F.col("__from")).where("id <> __to").select("id", F.col("__to").alias("ancestor"), (F.col("distance") + F.col("__more")).alias("distance"))
        pairs = staged(pairs.unionByName(further).groupBy("id", "ancestor").agg(F.min("distance").alias("distance")), "ancestors")
        reach *= 2
    names = nodes.select(F.col(id_col).alias("ancestor"), F.col(name).alias("ancestor_name"))
    return pairs.join(names, "ancestor").select("id", "ancestor", "ancestor_name", "distance")


def flatten(nodes: DataFrame, levels: int, id_col: str = "guid", parent: str = "parent_guid", name: str = "name") -> DataFrame:
    """(id, category, subcategory1, ...): ancestor names from the root down, null where there are fewer [KEY-07].

    The upper ``levels`` are walked down level by level, names in hand.  Every node below points to its
    parent, and pointers double until they meet the lowest of the upper levels, whose names they take:
    one row a node and round, and as many rounds as the logarithm of the depth.  Nodes that
    never meet it hang below a cycle; of those the ancestors are walked, as far as they differ.
    """
    known = staged(nodes.select(F.col(id_col).alias("id"), F.col(parent).alias("up"), F.col(name).alias("name")).where("id is not null"), "nodes")
    there = known.select(F.col("id").alias("up"))
    hung = known.join(there, "up", "left_semi").where("id <> up").select("id", "up")
    roots = known.join(hung, "id", "left_anti").select("id", F.expr("cast(array() as array<string>)").alias("names"))
    reached, level = [staged(roots, "level")], 0
    while level < levels and not reached[-1].isEmpty():
        above = reached[-1].join(known.select("id", "name"), "id").select(F.col("id").alias("up"), F.concat("names", F.array(F.col("name").cast("string"))).alias("names"))
        reached.append(staged(hung.join(above, "up").select("id", "names"), "level"))
        level += 1
    upper = staged(reduce(DataFrame.unionByName, reached), "upper")
    met = upper.select(F.col("id").alias("at"), F.lit(True).alias("met"))
    below = staged(hung.join(upper, "id", "left_anti").select("id", F.col("up").alias("at")).join(met, "at", "left").select("id", "at", F.coalesce("met", F.lit(False)).alias("met")), "below")
    most, reach, open_ = below.count(), 1, below.where("not met")
    while reach <= most and not open_.isEmpty():
        on = below.select(F.col("id").alias("__at"), F.col("at").alias("__next"), F.col("met").alias("__met"))
        moved = open_.join(on, F.col("at") == F.col("__at")).select("id", F.col("__next").alias("at"), F.col("__met").alias("met"))
        below = staged(below.where("met").unionByName(moved), "below")
        open_, reach = below.where("not met"), reach * 2
    deep = below.where("met").join(upper.withColumnRenamed("id", "at"), "at").select("id", "names")
    found = upper.unionByName(deep)
    if not open_.isEmpty():
        ring = known.join(open_.select("id"), "id", "left_semi")
        walked = ancestors(ring, "id", "up", "name").groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("d"), "ancestor_name"))), lambda x: x.ancestor_name.cast("string")).alias("names"))
        found = found.unionByName(walked)
    names = ["category", *[f"subcategory{k}" for k in range(1, levels)]]
    return nodes.select(F.col(id_col).alias("id")).join(found, "id", "left").select("id", *[F.try_element_at("names", F.lit(k + 1)).alias(n) for k, n in enumerate(names)])


def missing_parents(nodes: DataFrame, id_col: str = "guid", parent: str = "parent_guid") -> DataFrame:
    """Parents that are named but not there [JOI-18]."""
    named = nodes.select(F.col(parent).alias("__p")).where("__p is not null").distinct()
    return named.join(nodes, F.col("__p") == F.col(id_col), "left_anti").select(F.col("__p").alias(id_col))


def complete(nodes: DataFrame, fetch: Callable[[DataFrame], DataFrame], id_col: str = "guid", parent: str = "parent_guid") -> DataFrame:
    """Fetches missing parents level by level until none is missing or none is found [KEY-08]."""
    while not (lacking := staged(missing_parents(nodes, id_col, parent), "lacking")).isEmpty():
        found = staged(fetch(lacking).select(*nodes.columns).dropDuplicates([id_col]).join(nodes, id_col, "left_anti").select(*nodes.columns), "fetched")
        if found.isEmpty():
            break
        nodes = staged(nodes.unionByName(found), "completed")
    return nodes
