"""Datasets from specifications: filters, header and line joins, unions, prioritised projections."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.scalars import binary_auto, fix_year, hex_dump, norm_key, pack_refs, parse_date
from tallyloom.specs import ColumnSpec, SourceSpec, TargetSpec, UnionSpec

JOIN_KINDS = {"inner": "inner", "left": "left", "left outer": "left", "right": "right", "right outer": "right"}


def join_kind(text: str | None) -> str:
    """Normalises a join's name; what is unknown is inner [JOI-01]."""
    return JOIN_KINDS.get(" ".join((text or "").lower().replace("join", "").split()), "inner")


def in_period(df: DataFrame, column: str | None, start=None, end=None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included; an open end or no column does not filter [FLT-01]."""
    if not column:
        return df
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("timestamp"))
    return df if end is None else df.where(F.col(column) <= F.lit(end).cast("timestamp"))


def in_window(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from ``start`` to just before ``end`` [FLT-02]."""
    return df.where((F.col(column) >= F.lit(start).cast("timestamp")) & (F.col(column) < F.lit(end).cast("timestamp")))


def posted(df: DataFrame, flag: str = "is_posted", deleted: str = "is_deleted") -> DataFrame:
    """Documents that are posted and not marked as deleted [FLT-05]."""
    return df.where(F.coalesce(F.col(flag), F.lit(False)) & ~F.coalesce(F.col(deleted), F.lit(False)))


def inside_parts(headers: DataFrame, lines: DataFrame, key: str, part: Column, parts: Sequence[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Headers and lines of documents whose own partition is one of ``parts``, and one row with how many headers were dropped [FLT-09].

    A window that includes both ends also brings the document of the next month's first midnight.
    """
    inside = F.coalesce(part.isin(*parts), F.lit(False))
    kept = headers.where(inside)
    return kept, lines.join(kept.select(key).distinct(), key, "left_semi"), headers.agg(F.count_if(~inside).alias("dropped"))


def first_window(rows: DataFrame, key: str, window: str) -> DataFrame:
    """Each document in the first of the adjacent windows that brought it [FLT-10]; rows without a key stay."""
    first = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(window).alias("__first"))
    return rows.join(first, F.col(key) == F.col("__key"), "left").where(F.col("__first").isNull() | (F.col(window) == F.col("__first"))).select(*rows.columns)


def map_legacy(df: DataFrame, mapping: Mapping[str, str], transforms: Mapping[str, Callable[[Column], Column]] = {}) -> DataFrame:
    """Transforms by old name, renames, and the mapped columns that exist [PRJ-05]."""
    changed = df.withColumns({c: f(F.col(c)) for c, f in transforms.items() if c in df.columns})
    return changed.select(*[F.col(c).alias(n) for c, n in mapping.items() if c in df.columns])


def with_keys(df: DataFrame, column: str, keys: DataFrame, key: str, uuid: bool = False) -> DataFrame:
    """Rows whose key is listed; with ``uuid`` both sides are normalised and invalid keys match nothing [FLT-03, SRC-02]."""
    wanted = keys.select((norm_key(F.col(key)) if uuid else F.col(key)).alias("__key")).where("__key is not null").distinct()
    return df.join(wanted, (norm_key(F.col(column)) if uuid else F.col(column)) == F.col("__key"), "left_semi")


def project(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Renames, expressions and transforms; no specification keeps all columns [PRJ-01]."""
    if not columns:
        return df

    def build(c: ColumnSpec) -> Column:
        value = F.expr(c.expression) if c.expression else F.col(c.source or c.target)
        return (c.transform(value) if c.transform else value).alias(c.target)

    return df.select(*[build(c) for c in columns])


def include(df: DataFrame, columns: Sequence[str], always: Sequence[str] = ("etl_loaded_at",)) -> DataFrame:
    """The listed columns that exist, and those always kept [PRJ-02]."""
    return df.select(*[c for c in df.columns if not columns or c in columns or c in always])


def read_source(tables: Mapping[str, DataFrame], spec: SourceSpec, start=None, end=None, keys: DataFrame | None = None, key: str = "key") -> DataFrame:
    """A standalone or header table, or header joined to detail, filtered and projected [PIP-01].

    The period and keys apply where the document's own columns are: for a detail, on its parent.
    """
    own = spec.parent or spec
    base = in_period(tables[own.table], own.period, start, end)
    if keys is not None and own.key:
        base = with_keys(base, own.key, keys, key)
    if own.where:
        base = base.where(F.expr(own.where))
    if spec.parent is None:
        return project(base, spec.columns)
    detail = tables[spec.table]
    if spec.where:
        detail = detail.where(F.expr(spec.where))
    on = reduce(lambda a, b: a & b, [base[h] == detail[d] for h, d in spec.on.items()])
    return project(base.join(detail, on, join_kind(spec.join)), spec.columns)


def read_union(tables: Mapping[str, DataFrame], spec: UnionSpec, start=None, end=None) -> DataFrame:
    """All members' rows in the output's columns and types, duplicates kept [PIP-02, SET-01, PRJ-03]."""
    frames = []
    for member in spec.members:
        mapped = {c.target: c for c in (*(member.parent.columns if member.parent else ()), *member.columns)}  # a child's mapping wins
        df = read_source(tables, SourceSpec(**{**member.__dict__, "columns": tuple(mapped.values())}), start, end)
        frames.append(df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in spec.output]))
    return reduce(DataFrame.unionByName, frames)


def register_with_documents(register: DataFrame, headers: Mapping[int, DataFrame] | DataFrame, lines: Mapping[int, DataFrame] | DataFrame, *, key: str, kind: str, line: str, fields: Sequence[str], role: str = "dimension") -> DataFrame:
    """Movements with what their documents add [PIP-03, JOI-02, JOI-03, PRJ-04].

    A document table belongs to one type code.  Tables are united under their code, so that any number
    of types is one join for headers and one for lines; documents of several types that lie in one table
    may come as that table, with the column ``kind``.  For each field the movement's own column wins,
    then the headers' (for a dimension) or the lines' (for a fact), then null.
    """

    def united(parts: Mapping[int, DataFrame] | DataFrame, ids: Sequence[str], prefix: str) -> DataFrame | None:
        if isinstance(parts, DataFrame):
            return parts.select(*[F.col(c).alias(f"{prefix}{'kind' if c == kind else c}") for c in (kind, *ids, *[f for f in fields if f in parts.columns])])
        wanted = [f for f in fields if any(f in df.columns for df in parts.values())]
        frames = [df.select(F.lit(code).alias(f"{prefix}kind"), *[F.col(c).alias(f"{prefix}{c}") for c in ids], *[F.col(c).alias(f"{prefix}{c}") for c in wanted if c in df.columns]) for code, df in parts.items()]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None

    out = register
    for parts, ids, prefix in ((headers, [key], "__h_"), (lines, [key, line], "__l_")):
        side = united(parts, ids, prefix)
        if side is not None:
            on = [F.col(kind) == F.col(f"{prefix}kind"), *[F.col(c) == F.col(f"{prefix}{c}") for c in ids]]
            out = out.join(side, reduce(lambda a, b: a & b, on), "left")
    first = "__h_" if role == "dimension" else "__l_"
    chosen = []
    for f in fields:
        options = [c for c in (f, first + f) if c in (register.columns if c == f else out.columns)]
        chosen.append((F.coalesce(*[F.col(c) for c in options]) if options else F.lit(None)).alias(f))
    return out.select(*[c for c in (key, kind, line) if c not in fields], *chosen)


def denormalise(lines: DataFrame, headers: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str = "hdr_") -> DataFrame:
    """Header columns on every line, prefixed; a line without a header has nulls and ``hdr_missing`` [PRJ-07]."""
    side = headers.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(prefix + c) for c in columns], F.lit(True).alias("__found"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in keys])
    return lines.join(side, on, "left").withColumn(f"{prefix}missing", F.col("__found").isNull()).drop("__found", *[f"__{k}" for k in keys])


def first_line(lines: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A document's header: its first line [WIN-01]."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return lines.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_non_self(lines: DataFrame, keys: Sequence[str], order: Sequence[str], ref: str, own: str, to: str) -> DataFrame:
    """One row a document: its first set reference to another document, else the first line's [WIN-02]."""
    at = F.struct(*order)
    other = F.col(ref).isNotNull() & (F.col(ref) != F.col(own))
    return lines.groupBy(*keys).agg(F.coalesce(F.min_by(F.when(other, F.col(ref)), F.when(other, at)), F.min_by(ref, at)).alias(to))


def extract(df: DataFrame, transforms: Sequence[ColumnSpec], refs: Mapping[str, str], target: TargetSpec, order: Sequence[str]) -> DataFrame:
    """Dataset to target rows: transforms, packed references, header pick, included columns [PIP-04, PRJ-06, SCL-33].

    For a dimension the first line of each key stays; for a fact every line.
    """
    out = df.withColumns({c.target: (c.transform or (lambda x: x))(F.expr(c.expression) if c.expression else F.col(c.source or c.target)) for c in transforms})
    if refs:
        out = out.withColumn("raw_refs", pack_refs({k: F.col(c) for k, c in refs.items()}))
    if target.role == "dimension":
        out = first_line(out, target.keys, order)
    return include(out, (*target.include, *target.keys, *(("raw_refs",) if refs else ())))


def apply_transforms(df: DataFrame, columns: Sequence[ColumnSpec], computed: Mapping[str, tuple[Sequence[str], Column]] = {}, stamp: Column | None = None) -> DataFrame:
    """Configured transforms, then computed columns whose inputs exist, then the load stamp [PIP-05, UDF-01].

    A computed column that names a missing input raises ValueError.
    """
    out = df.withColumns({c.target: (c.transform or (lambda x: x))(F.col(c.source or c.target)) for c in columns})
    for name, (uses, value) in computed.items():
        if lacking := [u for u in uses if u not in out.columns]:
            raise ValueError(f"{name} needs {', '.join(lacking)}")
        out = out.withColumn(name, value)
    return out if stamp is None else out.withColumn("etl_loaded_at", stamp)


def frame_of(df: DataFrame, transforms: Sequence[ColumnSpec], refs: Mapping[str, str], target: TargetSpec, order: Sequence[str], key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``extract`` without repeated rows, one row with their number, and the keys that came back [PIP-04]."""
    rows = extract(df, transforms, refs, target, order).distinct()
    return rows, rows.agg(F.count("*").alias("n")), df.select(key).where(F.col(key).isNotNull()).distinct()


def auto_transforms(df: DataFrame, configured: Sequence[str] = (), periods: Sequence[str] = ("period", "date")) -> DataFrame:
    """Binary columns decoded by their length, and text or time columns named like a period brought out of the shifted calendar [PIP-05, PIP-06].

    Columns with a configured transform are left to it.
    """
    changes = {}
    for c, kind in df.dtypes:
        if c in configured:
            continue
        if kind == "binary":
            changes[c] = binary_auto(F.col(c))
        elif any(p in c.lower() for p in periods) and kind in ("string", "timestamp"):
            changes[c] = parse_date(F.col(c)) if kind == "string" else fix_year(F.col(c))
    return df.withColumns(changes) if changes else df


def with_raw(df: DataFrame, to: str = "raw_hex") -> DataFrame:
    """The row's binary columns as hex in one JSON text, beside what is decoded of them [PIP-06]."""
    binary = [c for c, kind in df.dtypes if kind == "binary"]
    return df.withColumn(to, hex_dump({c: F.col(c) for c in binary}) if binary else F.lit("{}"))


def over_frame(df: DataFrame, sql: str, name: str = "frame") -> DataFrame:
    """User SQL over the frame, named as ``{frame}`` in the text [AGG-04, UDF-03]."""
    return df.sparkSession.sql(sql, **{name: df})


def after_load(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """User SQL over what a load has left, each table by its name in braces [UDF-03]."""
    return spark.sql(sql, **tables)
