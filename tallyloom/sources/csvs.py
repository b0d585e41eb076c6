"""CSV feeds: market reports, user sheets and price caps, read with declared names and lenient values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.scalars import tidy


def read_text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Every column as text, named by the header; unnamed columns are ``_cN``."""
    return spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def sales_report(spark: SparkSession, path: str, rename: Mapping[str, str], numbers: Sequence[str], now: Column) -> DataFrame:
    """Renamed columns, bad numbers as 0, missing text as empty, stamped [SRC-08]."""
    df = read_text_csv(spark, path).withColumnsRenamed(dict(rename))
    value = {c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in numbers else F.coalesce(c, F.lit("")) for c in df.columns}
    return df.select(*[v.alias(c) for c, v in value.items()], now.alias("created_at"))


def product_report(spark: SparkSession, path: str, decimal_columns: Sequence[str] = ("ZZZ",), first_segment: int = 11) -> DataFrame:
    """``;``-separated; unnamed columns become Segment11, 12, ... in order; decimal commas are read [SRC-09]."""
    df = read_text_csv(spark, path, ";")
    names, k = [], first_segment
    for c in df.columns:
        if c.startswith("_c") or not c.strip():
            c, k = f"Segment{k}", k + 1
        names.append(c)
    df = df.toDF(*names)
    return df.withColumns({c: F.regexp_replace(c, ",", ".").try_cast("double") for c in decimal_columns if c in names})


def user_sheet(spark: SparkSession, path: str, names: Sequence[str], now: Column) -> DataFrame:
    """Fixed names, every text trimmed, stamped; the load replaces all [SRC-10]."""
    df = read_text_csv(spark, path)
    df = df.select(*df.columns[: len(names)]).toDF(*names)
    return df.select(*[F.trim(c).alias(c) for c in names], now.alias("etl_loaded_at"))


def price_caps(spark: SparkSession, path: str, names: Sequence[str] = ("product_id", "max_asp", "start_date", "end_date")) -> DataFrame:
    """Unnamed and all-null columns dropped, the first four kept; numbers without inner spaces, ``dd.MM.yyyy`` dates, 'nan' as null [SRC-11]."""
    df = read_text_csv(spark, path)
    named = [c for c in df.columns if not c.startswith("_c") and c.strip()]
    filled = df.agg(*[F.count(F.nullif(F.trim(F.col(f"`{c}`")), F.lit(""))).alias(f"n{k}") for k, c in enumerate(named)]).first()
    kept = [c for k, c in enumerate(named) if filled[k]][: len(names)]
    df = df.select(*[F.col(f"`{c}`") for c in kept]).toDF(*names[: len(kept)])
    text = {c: F.nullif(F.lower(tidy(F.col(c))), F.lit("nan")) for c in df.columns}
    number = lambda c: F.regexp_replace(F.regexp_replace(text[c], r"\s", ""), ",", ".").try_cast("double")
    build = {"max_asp": number, "start_date": lambda c: F.try_to_date(text[c], "dd.MM.yyyy"), "end_date": lambda c: F.try_to_date(text[c], "dd.MM.yyyy")}
    return df.select(*[build.get(c, lambda c: text[c])(c).alias(c) for c in df.columns])
