"""Runs over the files that earlier runs have not seen.

The files of all sources are listed as tables and compared with a ledger of those
processed before. What is new becomes one batch: its manifest is put down before the
job starts and committed after it has succeeded. A run that finds a batch that was not
committed repeats exactly that one first, whatever has arrived since.
"""

from __future__ import annotations

import dataclasses
import json
import re
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidewright.errors import JobError
from tidewright.names import require
from tidewright.sources import read_files
from tidewright.sources.listing import list_files
from tidewright.sources.tables import table_name
from tidewright.streaming.ledger import Ledger

if TYPE_CHECKING:
    from tidewright.plans.job import Job
    from tidewright.plans.spec import Source

# A run takes all new files at once.
_NOT_ALLOWED = {"maxfilespertrigger", "maxbytespertrigger"}

# Formats whose files can be followed.
_FILE_FORMATS = {"parquet", "orc", "csv", "json", "text", "avro", "xml"}


def run(spark: SparkSession, job: Job) -> bool:
    """Run ``job`` on the files that are new; False if there are none.

    File sources and tables kept in files are followed; other sources are read
    whole. The new files of all sources are one batch, begun and committed as a whole. The
    sink may see a batch twice if the driver dies between write and commit: the same
    files then, and no others. Two runs at a time are refused. Files are told apart by
    their paths: one that is written anew under its old name is not new.

    What earlier runs have seen stays in tables. The driver takes the names of
    one batch's files, which Spark's readers plan from.
    """
    state = require(job.state_path, "bookmark", "state_path").rstrip("/")
    marked = [_in_files(spark, source) for source in job.sources if source.source_type in ("s3", "file", "catalog")]
    if not marked:
        raise JobError("bookmark: there is no file source and no table")
    ledger = Ledger(spark, state)
    left_over = ledger.pending()
    if left_over is not None:
        _process(spark, job, marked, left_over, ledger)
    listed = [list_files(spark, source.path).withColumn("source", F.lit(source.name)) for source in marked]
    fresh = reduce(DataFrame.unionByName, listed).join(ledger.seen(), ["source", "path"], "left_anti")
    batch = ledger.begin(fresh)
    if batch is not None:
        _process(spark, job, marked, batch, ledger)
    return left_over is not None or batch is not None


def _in_files(spark: SparkSession, source: Source) -> Source:
    """The source as files: a table's own ones, if it is a table."""
    if source.source_type == "catalog":
        name = table_name(source.catalog, source.database, source.table)
        about = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])
        source = dataclasses.replace(
            source,
            source_type="file",
            path=about.get("location"),
            format=about.get("provider", ""),
            schema=spark.table(name).schema,
            options={**about.get("storage_properties", {}), **source.options},
        )
    if source.format.lower() not in _FILE_FORMATS:
        raise JobError(f"source '{source.name}': files of format '{source.format}' cannot be followed")
    if not isinstance(source.path, str):
        raise JobError(f"source '{source.name}': a bookmarked source has one path, which may be a glob")
    if any(option.lower() in _NOT_ALLOWED for option in source.options):
        raise JobError(f"source '{source.name}': a bookmarked run takes all new files, without {_NOT_ALLOWED}")
    return source


def _process(spark: SparkSession, job: Job, marked: list[Source], batch: DataFrame, ledger: Ledger) -> None:
    frames = {}
    for source in marked:
        own = batch.where(F.col("source") == source.name).select("path").orderBy("path")
        paths = [row.path for row in own.toLocalIterator()]
        frames[source.name] = _read_again(spark, source, paths) if paths else _empty(spark, source, ledger)
    job.write(spark, frames)
    ledger.commit()


def _empty(spark: SparkSession, source: Source, ledger: Ledger) -> DataFrame:
    """No rows, with the columns of the source: its schema, or that of a file seen before."""
    schema = source.schema
    if not isinstance(schema, StructType):
        known = ledger.seen().where(F.col("source") == source.name).orderBy(F.col("modified").desc(), "path").first()
        if known is not None:
            schema = _read_again(spark, dataclasses.replace(source, columns=[]), [known.path]).schema
        else:
            schema = read_files(spark, source.path, source.format, source.options, schema=schema).schema
    empty = spark.createDataFrame([], schema)
    return empty.select(*source.columns) if source.columns else empty


def _read_again(spark: SparkSession, source: Source, files: list[str]) -> DataFrame:
    """Just these files of a source; without a schema, it is theirs."""
    # Names are taken as patterns.
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", file) for file in files]
    options = dict(source.options)
    if not re.search(r"[\\{}\[\]*?]", source.path):
        options.setdefault("basePath", source.path)
    return read_files(spark, paths, source.format, options, source.columns, source.schema)
