"""Steps: plain functions from DataFrames to a DataFrame."""

from tidewright.operators.aggregates import aggregate
from tidewright.operators.columns import add_column, drop_columns, filter_rows, rename, select
from tidewright.operators.joins import join
from tidewright.operators.partitions import partition_columns
from tidewright.operators.sql import sql
from tidewright.operators.windows import WindowColumn, window, windows

__all__ = [
    "WindowColumn",
    "add_column",
    "aggregate",
    "drop_columns",
    "filter_rows",
    "join",
    "partition_columns",
    "rename",
    "select",
    "sql",
    "window",
    "windows",
]
