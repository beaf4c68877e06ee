"""A table that is created on first write and grows with its batches."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tidewright.errors import JobError, SchemaMismatch
from tidewright.functions.schema import (
    conform,
    has_void,
    kind_mismatches,
    merge_schema,
    nullable,
    void_free_ddl,
    void_free_schema,
)
from tidewright.names import column, fold, is_case_sensitive, require
from tidewright.sinks.files import arranged
from tidewright.sources.tables import table_name
from tidewright.work import settings, stage

# Properties a new Iceberg table is created with.
ICEBERG_PROPERTIES = {
    "format-version": "2",
    "write.spark.accept-any-schema": "true",
    "write.target-file-size-bytes": "536870912",
    "write.parquet.compression-codec": "zstd",
    "write.distribution-mode": "hash",
}


def write_evolving_table(
    df: DataFrame,
    database: str,
    table: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    fill_nulls: bool = True,
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
    catalog: str | None = None,
) -> None:
    """Create the table, or reconcile the batch with it and write.

    ``append`` adds the batch. ``overwrite`` replaces the partitions the batch
    has rows in and no others; a table without partitions is replaced whole.
    Columns the table has and the batch lacks become NULL, new columns are
    added at any depth, scalar types of the table stay, and a struct, array or
    map never changes into another kind: then nothing is written.
    ``fill_nulls=False`` takes the batch's columns as they are, and only adds
    new top-level ones.
    """
    require(database, "table sink", "database")
    require(table, "table sink", "table")
    if mode not in ("append", "overwrite"):
        raise JobError(f"table sink: 'mode' must be append or overwrite, not '{mode}'")
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table_name(catalog, database)}")
    if format == "iceberg":
        _write_iceberg(df, table_name(catalog, database, table), mode, partition_by, path, fill_nulls)
        return
    name, standby = table_name(database, table), table_name(database, f"{table}__evolving")
    _finish_interrupted(spark, name, standby)
    if not spark.catalog.tableExists(name):
        _create(_first_batch(df, fill_nulls), database, table, partition_by, path, format, options)
        return
    _evolve(df, name, standby, fill_nulls)
    target = spark.table(name).schema
    _insert(conform(df, target) if fill_nulls else _aligned(df, target), name, mode == "overwrite")


def _first_batch(df: DataFrame, fill_nulls: bool) -> DataFrame:
    if not fill_nulls or not has_void(df.schema):
        return df
    schema = void_free_schema(df.schema)
    if not schema.fields:
        raise SchemaMismatch("the batch has no column with a type")
    return conform(df, schema)


def _create(df, database, table, partition_by, path, format, options) -> None:
    # A path makes the table external, so that its description can be replaced
    # later on without touching its files.
    location = path or f"{df.sparkSession.catalog.getDatabase(table_name(database)).locationUri.rstrip('/')}/{table}"
    settings = {**({"compression": "zstd"} if format in ("parquet", "orc") else {}), **dict(options or {})}
    writer = arranged(df, partition_by).write.format(format).options(**settings).option("path", location)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table_name(database, table))


def _finish_interrupted(spark: SparkSession, name: str, standby: str) -> None:
    """Complete a change of schema that was cut off half-way."""
    if not spark.catalog.tableExists(standby):
        return
    found = _about(spark, standby)
    if not spark.catalog.tableExists(name):
        if found.get("type") != "EXTERNAL":
            raise JobError(f"{standby} is in the way: it is no description left by a change of {name}")
        spark.sql(f"ALTER TABLE {standby} RENAME TO {name}")
    elif found.get("type") == "EXTERNAL" and found["location"] == _about(spark, name)["location"]:
        spark.sql(f"DROP TABLE {standby}")
    else:
        raise JobError(f"{standby} is in the way: it is no description left by a change of {name}")


def _about(spark: SparkSession, name: str) -> dict:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()[0])


def _evolve(df: DataFrame, name: str, standby: str, fill_nulls: bool) -> None:
    spark, exact = df.sparkSession, is_case_sensitive(df)
    live = spark.table(name).schema
    batch = void_free_schema(df.schema) if fill_nulls else df.schema
    mismatches = kind_mismatches(batch, live, exact)
    if mismatches:
        raise SchemaMismatch(f"{name}: {'; '.join(mismatches)}; nothing was written")
    merged = merge_schema(live, batch, exact)
    if fill_nulls:
        conform(df, merged)  # refuses impossible casts before the table changes
    known = {fold(field.name, exact) for field in live.fields}
    added = [field for field in merged.fields if fold(field.name, exact) not in known]
    kept = StructType([field for field in merged.fields if fold(field.name, exact) in known])
    if fill_nulls and nullable(kept) != nullable(live):
        _replace_description(spark, name, standby, merged)
    elif added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns_ddl(added)})")


def _columns_ddl(fields: Sequence[StructField]) -> str:
    return ", ".join(f"{table_name(field.name)} {void_free_ddl(field.dataType)}" for field in fields)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pairs(values: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(key)} = {_text(value)}" for key, value in values.items())


def _replace_description(spark: SparkSession, name: str, standby: str, schema: StructType) -> None:
    """Describe the same files with new nested fields, which old files lack.

    The new description is complete under a second name before the old one
    goes, so a job cut off in between loses nothing.
    """
    about = _about(spark, name)
    if about.get("type") != "EXTERNAL" or about.get("bucket_columns"):
        raise SchemaMismatch(f"{name}: nested fields can only be added to an external table without buckets")
    described = spark.catalog.listColumns(name)
    partitions = [c.name for c in described if c.isPartition]
    comments = {c.name: f" COMMENT {_text(c.description)}" for c in described if c.description}
    fields = [field for field in schema.fields if field.name not in partitions]
    fields += [field for field in schema.fields if field.name in partitions]
    columns = ", ".join(_columns_ddl([field]) + comments.get(field.name, "") for field in fields)
    clauses = [f"CREATE TABLE {standby} ({columns}) USING {about['provider']}"]
    if partitions:
        clauses.append(f"PARTITIONED BY ({', '.join(table_name(p) for p in partitions)})")
    clauses.append(f"LOCATION {_text(about['location'])}")
    if about.get("storage_properties"):
        clauses.append(f"OPTIONS ({_pairs(about['storage_properties'])})")
    if about.get("comment"):
        clauses.append(f"COMMENT {_text(about['comment'])}")
    if about.get("table_properties"):
        clauses.append(f"TBLPROPERTIES ({_pairs(about['table_properties'])})")
    spark.sql(" ".join(clauses))
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {standby}")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {standby} RENAME TO {name}")


def _aligned(df: DataFrame, target: StructType) -> DataFrame:
    exact = is_case_sensitive(df)
    present = {fold(name, exact): name for name in df.columns}
    return df.select(
        *[
            column(present[fold(field.name, exact)]).alias(field.name)
            if fold(field.name, exact) in present
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in target.fields
        ]
    )


def _insert(df: DataFrame, name: str, overwrite: bool) -> None:
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not overwrite:
        arranged(df, partitions).write.insertInto(name)
        return
    # insertInto heeds the session's setting only: a writer option would be
    # ignored and every other partition deleted.
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        try:
            arranged(df, partitions).write.insertInto(name, overwrite=True)
        except AnalysisException as error:
            if not (error.getCondition() or "").startswith("UNSUPPORTED_OVERWRITE"):
                raise
            # The batch is read from the very table it replaces.
            arranged(stage(df), partitions).write.insertInto(name, overwrite=True)


def _write_iceberg(df, name, mode, partition_by, path, fill_nulls) -> None:
    """The same through Iceberg, which evolves the schema of its tables itself."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        writer = _first_batch(df, fill_nulls).writeTo(name).using("iceberg")
        if partition_by:
            writer = writer.partitionedBy(*[column(c) for c in partition_by])
        for key, value in ICEBERG_PROPERTIES.items():
            writer = writer.tableProperty(key, value)
        if path:
            writer = writer.tableProperty("location", path)
        writer.create()
        return
    live, exact = spark.table(name).schema, is_case_sensitive(df)
    if fill_nulls:
        batch = void_free_schema(df.schema)
        mismatches = kind_mismatches(batch, live, exact)
        if mismatches:
            raise SchemaMismatch(f"{name}: {'; '.join(mismatches)}; nothing was written")
        df = conform(df, merge_schema(live, batch, exact))
    else:
        first = [field.name for field in live.fields if field.name in df.columns]
        df = df.select(*[column(c) for c in first + [c for c in df.columns if c not in first]])
    writer = df.writeTo(name).option("merge-schema", "true")
    if mode == "overwrite":
        writer.overwritePartitions()
    else:
        writer.append()
