"""Files in any format Spark writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tidewright.names import column, require


def arranged(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one output partition brought together before they are written.

    Without this every task writes a file into every partition. Adaptive
    execution cuts a partition that is too large for one task into several and
    merges small ones, so a partition holding a third of the rows is no
    bottleneck.
    """
    return df.hint("rebalance", *[column(name) for name in partition_by]) if partition_by else df


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, object] | None = None,
) -> None:
    require(path, "file sink", "path")
    writer = arranged(df, partition_by).write.format(format).mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
