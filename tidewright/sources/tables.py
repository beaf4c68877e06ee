"""Tables of the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewright.names import require


def table_name(*parts: str | None) -> str:
    """The parts, quoted and joined by dots."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts if part)


def read_table(
    spark: SparkSession, database: str, table: str, columns: Sequence[str] = (), catalog: str | None = None
) -> DataFrame:
    require(database, "catalog source", "database")
    require(table, "catalog source", "table")
    df = spark.table(table_name(catalog, database, table))
    return df.select(*columns) if columns else df
