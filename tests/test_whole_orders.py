"""Signals and affected partitions over every order, not a subset of keys."""

from tallyloom.queries import QUERIES, parted, t

SF = "/root/testdata/sf0.001"


def test_signal_for_all_keys(spark):
    assert QUERIES["signal_for_all_keys"](spark, SF).count() == t(spark, SF, "orders").select("o_orderkey").distinct().count()


def test_affected_partitions_all_orders(spark):
    changed = parted(spark, SF).where("o_orderstatus = 'P' and o_orderdate >= '1996-01-01'").select("part").distinct()
    assert changed.count() > 0
    assert {r.part for r in changed.collect()} <= {r.part for r in QUERIES["affected_partitions_all_orders"](spark, SF).collect()}
