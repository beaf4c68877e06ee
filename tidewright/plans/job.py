"""Running a declared job as lazy DataFrames."""

from __future__ import annotations

import dataclasses
import importlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewright import operators, sinks, sources
from tidewright.errors import JobError
from tidewright.functions import pii
from tidewright.functions.registry import register
from tidewright.names import require
from tidewright.plans.spec import SINK_TYPES, SOURCE_TYPES, STEP_TYPES, Sink, Source, Step, build
from tidewright.streaming import incremental
from tidewright.work import settings

Frames = dict[str, DataFrame]

# Split the skewed partitions of a join even if what comes after, such as an
# aggregation by the same key, then needs a shuffle of its own.
_WHILE_WRITING = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


@dataclass
class Job:
    """Sources, then steps, then partition columns, masking and the sink.

    A step reads the first source unless it names another frame, and rebinds
    what it reads unless it names an output. Partition columns and masking
    belong to the sink: a job without one has neither. ``body``, a function
    of the session and the source frames, replaces steps and sink.
    """

    sources: list[Source] = field(default_factory=list)
    transforms: list[Step] = field(default_factory=list)
    sink: Sink | None = None
    mask_pii: list[str] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    partition_timestamp_column: str | None = None
    create_timestamp: bool = False
    functions: Mapping[str, Any] = field(default_factory=dict)
    body: Callable[[SparkSession, Frames], DataFrame | None] | str | None = None
    bookmark: str = "disabled"
    state_path: str | None = None

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> Job:
        """A job from nested mappings, as JSON or YAML files hold them.

        ``imports`` lists functions by ``name`` and the module they come
        ``from``. Of ``config``, which describes a service to run the job on,
        only a ``bookmark`` setting counts; ``job_type`` is not needed.
        """
        given = dict(config)
        given.pop("job_type", None)
        for provider in (given.pop("config", None) or {}).values():
            if isinstance(provider, Mapping) and "bookmark" in provider:
                given.setdefault("bookmark", provider["bookmark"])
        given["functions"] = {**_imported(given.pop("imports", None) or []), **(given.get("functions") or {})}
        given["sources"] = [
            build(Source, source, f"source '{source.get('name')}'", "source_type", SOURCE_TYPES)
            for source in given.get("sources") or []
        ]
        given["transforms"] = [
            build(Step, step, f"transform {at}", "transform_type", STEP_TYPES)
            for at, step in enumerate(given.get("transforms") or [])
        ]
        if given.get("sink") is not None:
            given["sink"] = build(Sink, given["sink"], "sink", "sink_type", SINK_TYPES)
        job = build(cls, given, "job")
        if job.bookmark not in ("enabled", "disabled"):
            raise JobError(f"job: 'bookmark' must be enabled or disabled, not '{job.bookmark}'")
        return job

    @classmethod
    def from_yaml(cls, text: str) -> Job:
        try:
            import yaml
        except ImportError:
            raise JobError("reading YAML needs PyYAML") from None
        return cls.from_dict(yaml.safe_load(text))

    @property
    def default_source(self) -> str:
        return self.sources[0].name if self.sources else "source"

    def frames(self, spark: SparkSession, given: Mapping[str, DataFrame] | None = None) -> Frames:
        """Every named frame after the last step.

        ``given`` stands in for sources of those names. Nothing is computed
        but the group sizes that window steps and outer joins ask for.
        """
        register(spark, self.functions)
        frames = self._read(spark, given or {})
        for steps in self._together():
            output, df = self._apply(spark, steps, frames)
            frames[output] = df
        return frames

    def _together(self) -> Iterator[list[Step]]:
        """Single steps, but window steps that extend one frame as a run."""
        run: list[Step] = []
        for step in self.transforms:
            source = step.source or self.default_source
            extends = step.transform_type == "window" and step.output in (None, source)
            if run and not (extends and source == (run[0].source or self.default_source)
                            and step.hot_rows == run[0].hot_rows):
                yield run
                run = []
            if extends:
                run.append(step)
            else:
                yield [step]
        if run:
            yield run

    def result(self, spark: SparkSession, given: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """What the sink receives, or the default frame of a job without one."""
        if self.body is not None:
            register(spark, self.functions)
            return self._callable(self.body, "body")(spark, self._read(spark, given or {}))
        frames = self.frames(spark, given)
        name = (self.sink.source if self.sink else None) or self.default_source
        df = _named(frames, name, "sink")
        if self.sink is None:
            return df
        df = operators.partition_columns(
            df, self.partition_by, self.partition_timestamp_column, self.create_timestamp
        )
        return pii.redact(df, self.mask_pii)

    def run(self, spark: SparkSession) -> None:
        """Compute and write; with bookmarks, from the files not yet processed."""
        if self.bookmark == "enabled":
            incremental.run(spark, self)
        else:
            self.write(spark)

    def write(self, spark: SparkSession, given: Mapping[str, DataFrame] | None = None) -> None:
        if self.body is None and self.sink is not None and self.sink.sink_type == "iceberg":
            _require_iceberg(spark, self.sink)
        df = self.result(spark, given)
        if self.sink is not None and self.body is None:
            with settings(spark, _WHILE_WRITING):
                _write(df, self._effective_sink())

    def _callable(self, function: Callable | str, what: str) -> Callable:
        """The function itself, or the one given or imported under that name."""
        if isinstance(function, str):
            function = require(self.functions.get(function), what, function)
        return function

    def _effective_sink(self) -> Sink:
        sink = self.sink
        if sink.sink_type in ("iceberg", "table") and not sink.partition_by and self.partition_by:
            return dataclasses.replace(sink, partition_by=list(self.partition_by))
        return sink

    def _read(self, spark: SparkSession, given: Mapping[str, DataFrame]) -> Frames:
        return {s.name: given[s.name] if s.name in given else read(spark, s) for s in self.sources}

    def _apply(self, spark: SparkSession, steps: list[Step], frames: Frames) -> tuple[str, DataFrame]:
        step = steps[0]
        kind = step.transform_type
        if kind == "sql":
            return step.output or self.default_source, operators.sql(spark, frames, step.query)
        if kind == "join":
            left = step.left or self.default_source
            right = _named(frames, require(step.right, "join transform", "right"), "join transform")
            on = require(step.on, "join transform", "on")
            joined = operators.join(_named(frames, left, "join transform"), right, on, step.how, step.hot_rows)
            return step.output or left, joined
        source = step.source or self.default_source
        output = step.output or source
        if kind == "custom":
            function = require(step.function, "custom transform", "function")
            return output, self._callable(function, "custom transform")(spark, dict(frames))
        df = _named(frames, source, f"{kind} transform")
        if kind == "window":
            columns = [operators.WindowColumn(s.name, s.expression, s.partition_by, s.order_by) for s in steps]
            return output, operators.windows(df, columns, step.hot_rows)
        return output, _STEPS[kind](df, step)


def _imported(imports: Sequence[Mapping[str, str]]) -> dict[str, Any]:
    functions = {}
    for entry in imports:
        name, module = require(entry.get("name"), "import", "name"), entry.get("from")
        try:
            # Without a module to take it from, the name is a module itself.
            functions[name] = getattr(importlib.import_module(module), name) if module else importlib.import_module(name)
        except (ImportError, AttributeError) as error:
            raise JobError(f"import: {error}") from None
    return functions


def _named(frames: Frames, name: str, what: str) -> DataFrame:
    if name not in frames:
        raise JobError(f"{what}: no frame is called '{name}', there are {sorted(frames)}")
    return frames[name]


_STEPS: dict[str, Callable[[DataFrame, Step], DataFrame]] = {
    "filter": lambda df, step: operators.filter_rows(df, step.condition),
    "select": lambda df, step: operators.select(df, step.columns),
    "drop_columns": lambda df, step: operators.drop_columns(df, step.columns),
    "rename": lambda df, step: operators.rename(df, step.mapping),
    "add_column": lambda df, step: operators.add_column(
        df, require(step.name, "add_column transform", "name"), step.expression
    ),
    "aggregate": lambda df, step: operators.aggregate(df, step.group_by, step.aggs, step.hot_rows),
}


def _jdbc(description: Source | Sink) -> dict[str, Any]:
    names = ("table", "connection_url", "connection_type", "database", "auth", "options")
    return {name: getattr(description, name) for name in names}


def _paging(source: Source) -> dict[str, str]:
    """Where a document keeps its records and the address of the next one."""
    unknown = sorted(set(source.options) - {"next", "records"})
    if unknown:
        raise JobError(f"source '{source.name}': unknown options {unknown}")
    return dict(source.options)


def read(spark: SparkSession, source: Source) -> DataFrame:
    match source.source_type:
        case "s3" | "file":
            return sources.read_files(
                spark, source.path, source.format, source.options, source.columns, source.schema
            )
        case "jdbc":
            return sources.read_jdbc(spark, source.columns, **_jdbc(source))
        case "catalog":
            return sources.read_table(spark, source.database, source.table, source.columns, source.catalog)
        case "kafka":
            return sources.read_kafka(spark, source.connection_url, source.topic, source.options)
        case "api" | "http":
            return sources.read_http_json(
                spark, source.url, source.schema, source.headers, source.pages, **_paging(source)
            )
        case "frame":
            return source.frame
    raise JobError(f"source '{source.name}': unknown type '{source.source_type}'")


def _require_iceberg(spark: SparkSession, sink: Sink) -> None:
    """Refuse an ``iceberg`` sink unless its catalog, or the session's own, is an Iceberg one."""
    name = sink.catalog or "spark_catalog"
    implementation = spark.conf.get(f"spark.sql.catalog.{name}", None) or ""
    if "iceberg" not in implementation.lower():
        catalogs = f"catalog '{name}' is " + (f"'{implementation}'" if implementation else "not configured")
        raise JobError(f"sink: {catalogs}; an iceberg sink needs an Iceberg catalog, a 'table' sink keeps Parquet files")


def _write(df: DataFrame, sink: Sink) -> None:
    match sink.sink_type:
        case "s3" | "file":
            sinks.write_files(df, sink.path, sink.format, sink.mode, sink.partition_by, sink.options)
        case "jdbc":
            sinks.write_jdbc(df, sink.mode, **_jdbc(sink))
        case "catalog":
            sinks.append_to_table(df, sink.database, sink.table, sink.catalog)
        case "iceberg" | "table":
            known = sink.catalog and df.sparkSession.conf.get(f"spark.sql.catalog.{sink.catalog}", None)
            sinks.write_evolving_table(
                df,
                sink.database,
                sink.table,
                sink.mode,
                sink.partition_by,
                sink.path,
                sink.fill_nulls,
                "iceberg" if sink.sink_type == "iceberg" else sink.format,
                sink.options,
                sink.catalog if known else None,
            )
        case _:
            raise JobError(f"sink: unknown type '{sink.sink_type}'")
