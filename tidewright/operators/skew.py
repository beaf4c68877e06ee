"""Finding the groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewright.names import column
from tidewright.work import stage

#: Rows one task may hold of a single group before the group is split.
HOT_ROWS = 2_000_000

#: Frames known to have no more rows are broadcast, and hot groups listed on the
#: driver; beyond it they stay tables, joined as Spark sees fit.
SMALL_ROWS = 1_000


@dataclass
class HotGroups:
    """Keys and row count of every hot group: how many, and their rows together."""

    frame: DataFrame
    groups: int
    rows: int


def hot_groups(
    df: DataFrame, keys: Sequence[str], names: Sequence[str], size: str, hot_rows: int | None = None
) -> HotGroups | None:
    """All groups over ``hot_rows``: their keys as ``names``, and ``size``.

    One pass that reads the key columns only and counts before it shuffles. At
    most SMALL_ROWS + 1 groups reach the driver; more are written to a table.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    counted = df.groupBy(*[column(key).alias(name) for key, name in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias(size)
    )
    over = counted.filter(F.col(size) > limit)
    listed = over.limit(SMALL_ROWS + 1).collect()
    if not listed:
        return None
    if len(listed) <= SMALL_ROWS:
        fields = [StructField(name, counted.schema[name].dataType, True) for name in names]
        schema = StructType([*fields, StructField(size, LongType(), False)])
        frame = df.sparkSession.createDataFrame([tuple(row) for row in listed], schema)
        return HotGroups(frame, len(listed), sum(row[-1] for row in listed))
    frame = stage(over)
    groups, rows = frame.agg(F.count(F.lit(1)), F.sum(size)).first()
    return HotGroups(frame, groups, rows)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which has at most ``rows`` rows, marked for broadcast if those are few."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of two key lists in which NULL equals NULL."""
    return reduce(Column.__and__, [column(a).eqNullSafe(column(b)) for a, b in zip(left, right)], F.lit(True))
