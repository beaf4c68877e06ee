"""Joining each row to the latest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.errors import JobError
from tidewright.names import column
from tidewright.operators.skew import same_keys, small
from tidewright.work import stage


def join_as_of(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    *,
    right_columns: Sequence[str] | None = None,
    tie_by: Sequence[str] = (),
    forward: bool = False,
    strict: bool = False,
    within: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the columns of the nearest row of ``right`` that has its keys.

    That is the latest at or before ``left_time``, or with ``forward`` the earliest at or after it;
    with ``strict`` not at the same time. ``within``, SQL for a number or an interval, is how far off it may be.
    Of rows at one time, the last by ``tie_by`` is taken, by any order if that ties too. ``right_columns``
    are those to add: all but the keys if not given. Rows of ``left`` without a match, or with NULL among keys or time, have
    NULLs there; rows of ``right`` with such NULLs match nothing.

    Both tables are laid out once, in ranges of (keys, time), so that a key with very many rows is several tasks.
    Within a range the nearest row is found by a window; over its edge comes the last row of the ranges before,
    of which each range has at most one key that goes on.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        raise JobError("as-of join: 'on' is required")
    added = [c for c in right.columns if c not in keys] if right_columns is None else list(right_columns)
    clash = {c.lower() for c in left.columns} & {c.lower() for c in added}
    if clash:
        raise JobError(f"as-of join: both sides have {sorted(clash)}")
    names = [f"k{i}" for i in range(len(keys))]
    known = reduce(Column.__and__, [column(k).isNotNull() for k in keys])
    own = F.struct(*[column(c) for c in left.columns])
    other = F.struct(column(right_time).alias("time"), F.struct(*[column(c) for c in added]).alias("row"))
    # The side decides who comes first at one time: what may match comes before what looks for it.
    sides = (0, 1) if strict else (1, 0)
    ties = [F.col(f"t{i}") for i in range(len(tie_by))]
    rows = left.where(known & column(left_time).isNotNull()).select(
        *[column(k).alias(n) for k, n in zip(keys, names)], column(left_time).alias("time"), F.lit(sides[0]).alias("side"),
        *[F.lit(None).cast(right.select(column(c).alias("t")).schema["t"].dataType).alias(f"t{i}") for i, c in enumerate(tie_by)],
        own.alias("own"), F.lit(None).cast(right.select(other.alias("o")).schema["o"].dataType).alias("other"),
    ).unionByName(
        right.where(known & column(right_time).isNotNull()).select(
            *[column(k).alias(n) for k, n in zip(keys, names)], column(right_time).alias("time"), F.lit(sides[1]).alias("side"),
            *[column(c).alias(f"t{i}") for i, c in enumerate(tie_by)],
            F.lit(None).cast(left.select(own.alias("o")).schema["o"].dataType).alias("own"), other.alias("other"),
        )
    )
    time = F.col("time").desc() if forward else F.col("time").asc()
    sorts = [time, F.col("side").asc(), *[t.asc() for t in ties]]
    buckets = buckets or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(buckets, *[F.col(n).asc() for n in names], *sorts)
    # Kept: the bounds are drawn from a sample, and every reading must see the same buckets.
    laid = stage(placed.withColumn("bucket", F.spark_partition_id()))

    here = Window.partitionBy("bucket", *names).orderBy(*sorts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nearest = F.last("other", ignorenulls=True).over(here)
    # The last row that may match, in the order of the bucket.
    place = F.row_number().over(Window.partitionBy("bucket", *names).orderBy(*sorts))
    ends = laid.withColumn("place", place).groupBy("bucket", *names).agg(
        F.max_by("other", F.when(F.col("other").isNotNull(), F.col("place"))).alias("last")
    )
    along = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("carry", F.last("last", ignorenulls=True).over(along)).where("carry is not null")
    others = ["in_bucket", *[f"in_{n}" for n in names]]
    carried = carried.select(*[F.col(a).alias(b) for a, b in zip(["bucket", *names], others)], "carry")
    # A key goes on into a bucket only as its first key, so that there is a carry a bucket at most.
    found = laid.withColumn("nearest", nearest).where("own is not null").join(
        small(carried, buckets), same_keys(["bucket", *names], others), "left"
    )
    match = F.coalesce("nearest", "carry")
    if within is not None:
        limit = F.expr(within)
        apart = F.col("time") + limit >= match["time"] if forward else match["time"] + limit >= F.col("time")
        match = F.when(apart, match)
    matched = found.select("own", match["row"].alias("row"))
    rest = left.where(~F.coalesce(known & column(left_time).isNotNull(), F.lit(False))).select(
        own.alias("own"), F.lit(None).cast(matched.schema["row"].dataType).alias("row")
    )
    both = matched.unionByName(rest)
    return both.select(
        *[F.col("own")[c].alias(c) for c in left.columns], *[F.col("row")[c].alias(c) for c in added]
    )
