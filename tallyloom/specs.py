"""Plain descriptions of datasets and targets; operators turn them into DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column


@dataclass(frozen=True)
class ColumnSpec:
    """A target column from a source column or an SQL expression, with an optional transform."""

    target: str
    source: str | None = None
    expression: str | None = None
    transform: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class SourceSpec:
    """A table: ``standalone`` movements, ``header`` documents, or ``detail`` lines of a parent header."""

    table: str
    kind: str = "standalone"
    columns: tuple[ColumnSpec, ...] = ()
    period: str | None = None
    key: str | None = None
    where: str | None = None
    parent: SourceSpec | None = None
    on: Mapping[str, str] = field(default_factory=dict)
    join: str = "inner"


@dataclass(frozen=True)
class UnionSpec:
    """Members projected to common columns; what a member lacks is null."""

    members: tuple[SourceSpec, ...]
    output: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class TargetSpec:
    """Where rows go: load mode, key columns, and the columns it takes."""

    name: str
    mode: str = "upsert"
    keys: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    role: str = "fact"
    priority: int = 0


@dataclass(frozen=True)
class PublishSpec:
    """What makes a partition of a published table equal to its source."""

    partition: str
    business_key: tuple[str, ...]
    document: tuple[str, ...]
    checksum: tuple[str, ...]
    measures: tuple[str, ...]
    not_zero: tuple[str, ...] = ()
    not_empty: tuple[str, ...] = ()
    on_empty: str = "fail"
