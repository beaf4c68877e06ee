"""Databases reached through JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewright.sources.jdbc import jdbc_options


def write_jdbc(df: DataFrame, mode: str = "overwrite", **description) -> None:
    """Each task writes its rows over a connection of its own.

    A ``numPartitions`` option bounds the number of connections. A task that
    is run again repeats its rows, unless the table has a key.
    """
    df.write.format("jdbc").options(**jdbc_options(**description)).mode(mode).save()
