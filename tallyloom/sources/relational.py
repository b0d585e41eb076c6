"""Scans: tables or queries of a relational source, by period, keys or partition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalars import is_uuid, norm_key, to_local
from tallyloom.operators.datasets import in_period, with_keys


def read_jdbc(spark: SparkSession, url: str, query: str, *, split_on: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, fetch: int = 10_000, **options) -> DataFrame:
    """A query of a relational source, fetched in batches, in ``parts`` ranges of ``split_on`` at once [SRC-01, SRC-06].

    Without ``bounds`` the source is asked for the least and the largest ``split_on`` first; with no row
    there is nothing to split.
    """
    reader = lambda: spark.read.format("jdbc").options(url=url, fetchsize=fetch, **options)  # noqa: E731 - a reader keeps the options it was given
    if split_on is not None and bounds is None:
        low, high = reader().option("query", f"select min({split_on}) as low, max({split_on}) as high from ({query}) q").load().first()
        bounds = None if low is None else (low, high)
    if split_on is None or bounds is None:
        return reader().option("query", query).load()
    return reader().options(dbtable=f"({query}) q", partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts).load()


#: Keys that a split is planned from; with it a range holds within a few per cent of its share.
SPLIT_SAMPLE = 20_000


def even_bounds(keys: DataFrame, parts: int, sample: int = SPLIT_SAMPLE, seed: int = 7) -> list:
    """At most ``parts`` - 1 values that cut the one column of ``keys`` into ranges of about equal numbers of rows.

    They are taken from a sample of bounded size; a value that holds more than a range's share is a range of its own.
    """
    column = keys.columns[0]
    drawn = sorted(r[0] for r in keys.where(F.col(column).isNotNull()).orderBy(F.rand(seed)).limit(sample).collect())
    cuts = [drawn[len(drawn) * k // parts] for k in range(1, parts)] if drawn else []
    return sorted({c for c in cuts if c > drawn[0]}) if drawn else []


def literal(value) -> str:
    """A number, text, date or uuid in SQL."""
    return str(value) if isinstance(value, int | float) and not isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


def read_even(spark: SparkSession, url: str, query: str, split_on: str, *, parts: int = 8, sample_query: str | None = None, fetch: int = 10_000, **options) -> DataFrame:
    """A query of a relational source, read in ranges of about equal numbers of rows, however its keys are spread [SRC-01, SRC-06].

    ``split_on`` may be a number, a text, a date or a uuid: whatever the source compares as Spark does.  Only that column
    is read to plan the ranges, from ``sample_query`` if the source has a cheaper way to a sample of its
    keys.  Rows of a null key are read with the first range.
    """
    reader = lambda: spark.read.format("jdbc").options(url=url, fetchsize=fetch, **options)
    bounds = [literal(b) for b in even_bounds(reader().option("query", f"select {split_on} from ({sample_query or query}) q").load(), parts)]
    if not bounds:
        return reader().option("query", query).load()
    inner = [f"{split_on} >= {a} and {split_on} < {b}" for a, b in zip(bounds, bounds[1:])]
    ranges = [f"{split_on} < {bounds[0]} or {split_on} is null", *inner, f"{split_on} >= {bounds[-1]}"]
    return spark.read.jdbc(url, f"({query}) q", predicates=ranges, properties={"fetchsize": str(fetch)} | {k: str(v) for k, v in options.items()})


def scan(df: DataFrame, *, period: str | None = None, start=None, end=None, key: str | None = None, keys: DataFrame | None = None, key_name: str = "key") -> DataFrame:
    """By period, both ends included, or by listed keys [SRC-02]."""
    df = in_period(df, period, start, end)
    return df if keys is None or key is None else with_keys(df, key, keys, key_name)


def scan_key(df: DataFrame, key: str, value: str | None, uuid: bool = True) -> DataFrame:
    """One key's rows; an invalid key has none [SRC-03].

    Only the asked key is brought to canonical form, so the comparison with the column reaches the scan.
    """
    wanted = norm_key(F.lit(value).cast("string")) if uuid else F.lit(value)
    return df.where(F.col(key) == wanted)


def document(headers: DataFrame, details: Mapping[str, DataFrame], key: str, value) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One document: its header row and each of its line tables [SRC-04]."""
    return headers.where(F.col(key) == F.lit(value)), {n: d.where(F.col(key) == F.lit(value)) for n, d in details.items()}


def partition_of(df: DataFrame, columns: Mapping[str, str], part: str, value: int) -> DataFrame:
    """A partition's rows, each target column from its expression [SRC-05]; the filter reaches the scan."""
    return df.where(F.col(part) == value).select(*[F.expr(e).alias(t) for t, e in columns.items()])


def partitions(df: DataFrame, part: str) -> DataFrame:
    """[SRC-07]"""
    return df.select(part).distinct()


def of_guids(reference: DataFrame, guids: DataFrame, guid: str) -> DataFrame:
    """Attributes of listed references [SRC-15]."""
    return reference.join(guids.select(guid).distinct(), guid, "left_semi")


def live_products(feed: DataFrame, guid: str, names: Mapping[str, str], at: str) -> DataFrame:
    """Rows not deleted and of a valid guid; texts trimmed, time local [SRC-16, FLT-07, FLT-08]."""
    if "deleted_at" in feed.columns:
        feed = feed.where("deleted_at is null")
    return feed.where(is_uuid(F.col(guid))).select(F.lower(F.trim(guid)).alias(guid), *[F.trim(c).alias(t) for t, c in names.items()], to_local(F.col(at)).alias(at))


def of_day(df: DataFrame, at: str, day: str) -> DataFrame:
    """A day's rows in order of time [SRC-17]; the bounds reach the scan."""
    begin = F.lit(day).cast("timestamp")
    return df.where((F.col(at) >= begin) & (F.col(at) < begin + F.expr("INTERVAL 1 DAY"))).orderBy(at)
