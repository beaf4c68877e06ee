"""Existing tables of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewright.names import column, require
from tidewright.sinks.files import arranged
from tidewright.sources.tables import table_name


def append_to_table(df: DataFrame, database: str, table: str, catalog: str | None = None) -> None:
    """Append by column name; columns the table lacks are left out."""
    require(database, "catalog sink", "database")
    require(table, "catalog sink", "table")
    name = table_name(catalog, database, table)
    columns = df.sparkSession.catalog.listColumns(name)
    ordered = df.select(*[column(c.name) for c in columns])
    arranged(ordered, [c.name for c in columns if c.isPartition]).write.insertInto(name)
