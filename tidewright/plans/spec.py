"""What a job is made of."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql.types import StructType

from tidewright.errors import JobError
from tidewright.names import Expression

# Kinds of sources, sinks and steps.
SOURCE_TYPES = ("s3", "file", "jdbc", "catalog", "kafka", "api", "http", "frame")
SINK_TYPES = ("s3", "file", "jdbc", "catalog", "iceberg", "table")
STEP_TYPES = (
    "filter",
    "sql",
    "join",
    "drop_columns",
    "select",
    "rename",
    "add_column",
    "aggregate",
    "window",
    "custom",
)


@dataclass
class Source:
    """``frame`` takes a DataFrame from code; ``engine`` is accepted and unused."""

    name: str
    source_type: str
    format: str = "parquet"
    path: str | Sequence[str] | None = None
    connection_url: str | None = None
    connection_type: str | None = None
    catalog: str | None = None
    database: str | None = None
    table: str | None = None
    topic: str | None = None
    url: str | Sequence[str] | None = None
    headers: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None
    pages: Mapping[str, int] | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    auth: Mapping[str, Any] | None = None
    columns: Sequence[str] = ()
    engine: str | None = None
    frame: Any = None


@dataclass
class Step:
    transform_type: str
    source: str | None = None
    output: str | None = None
    condition: Expression | None = None
    query: str = "SELECT * FROM source"
    columns: Sequence[str] = ()
    mapping: Mapping[str, str] = field(default_factory=dict)
    name: str | None = None
    expression: Expression | None = None
    left: str | None = None
    right: str | None = None
    on: str | Sequence[str] | None = None
    how: str = "inner"
    group_by: Sequence[str] = ()
    aggs: Mapping[str, Expression] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    order_by: Sequence[Any] = ()
    hot_rows: int | None = None
    function: Callable | str | None = None


@dataclass
class Sink:
    """``catalog_id`` is accepted and unused: the session knows its catalogs."""

    sink_type: str
    source: str | None = None
    format: str = "parquet"
    path: str | None = None
    connection_url: str | None = None
    connection_type: str | None = None
    catalog: str | None = None
    database: str | None = None
    table: str | None = None
    mode: str = "overwrite"
    partition_by: Sequence[str] = ()
    fill_nulls: bool = True
    options: Mapping[str, Any] = field(default_factory=dict)
    auth: Mapping[str, Any] | None = None
    catalog_id: str | None = None


def build(kind: type, given: Mapping[str, Any], what: str, choice: str | None = None, choices: Sequence[str] = ()):
    """An instance of ``kind`` from a mapping; settings left out or None default."""
    known = {f.name for f in fields(kind)}
    unknown = sorted(set(given) - known)
    if unknown:
        raise JobError(f"{what}: unknown settings {unknown}")
    if choice and given.get(choice) not in choices:
        raise JobError(f"{what}: '{choice}' must be one of {list(choices)}, not {given.get(choice)!r}")
    try:
        return kind(**{key: value for key, value in given.items() if value is not None})
    except TypeError as error:
        raise JobError(f"{what}: {error}") from None
