"""Joining spans that overlap, whatever their lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from tidewright.errors import JobError
from tidewright.names import column
from tidewright.work import stage

# Rows of a key up to which, on either side, each meets all of the other's: compared pairs are then so many times the rows at most.
_FEW = 500
# Keys with more that are broadcast.
_MANY_KEYS = 10_000
# Levels of starts of the left are set apart from those of the right; -1 is a whole key.
_LEFT_STARTS = 100


def join_overlapping(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    on: str | Sequence[str] = (),
    *,
    unit_seconds: int = 86_400,
) -> DataFrame:
    """Pairs of rows with equal keys ``on`` whose spans share a point: all columns of both, the keys once.

    A span has its first and its last point, both included: integers, dates or timestamps. NULLs, and spans that end
    before they start, overlap nothing. Repeated rows are repeated pairs.

    Keys with few rows on either side meet as they are, each row shuffled once. For the others (a count of the keys says
    which; without keys it is all), two spans overlap if one starts within the other. So every span is posted as the bins of a
    dyadic hierarchy that cover it exactly, at most two of each size, and every start as the bins that hold it, one of
    each size up to the other side's longest span's. A start lies in exactly one bin of the cover of a span that holds it, so that a pair
    meets once, and rows grow with the spans and the logarithm of their length. Timestamps are laid on units of
    ``unit_seconds``; pairs that meet in a unit only are filtered out at the end. Spark's size estimates know nothing of the
    postings, so it is told to merge them and never collects them on the driver.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - {k.lower() for k in keys}
    if clash:
        raise JobError(f"overlap join: both sides have {sorted(clash)}")
    a, b = _spans(left, left_span, keys, unit_seconds, "l"), _spans(right, right_span, keys, unit_seconds, "r")
    names = [f"k{i}" for i in range(len(keys))]
    meet, met_once = names, F.lit(True)
    if keys:
        counted = [
            side.groupBy(*names).agg(F.count(F.lit(1)).alias(f"{letter}_n"), F.max(_level()).alias(f"{letter}_top")).where(f"{letter}_n > {_FEW}")
            for side, letter in ((a, "l"), (b, "r"))
        ]
        many = stage(counted[0].join(counted[1], names))
        n, *tops = many.agg(F.count(F.lit(1)), F.max("l_top"), F.max("r_top")).first()
    else:
        n, *tops = None, *[side.agg(F.max(_level())).first()[0] or 0 for side in (a, b)]
    if n != 0:
        if keys:
            marks = many.select(*names, F.lit(True).alias("many"))
            marks = F.broadcast(marks) if n <= _MANY_KEYS else marks.hint("merge")
            a, b = a.join(marks, names, "left"), b.join(marks, names, "left")
        else:
            a, b = (side.withColumn("many", F.lit(True)) for side in (a, b))
        a, b = _posted(a, 0, _LEFT_STARTS, tops[1]), _posted(b, _LEFT_STARTS, 0, tops[0])
        meet = [*names, "level", "bin"]
        # Both starting at one point meet at the right's starts.
        met_once = (F.col("level") < _LEFT_STARTS) | (F.col("l_from") > F.col("r_from"))
    overlap = (F.col("l_first") <= F.col("r_last")) & (F.col("r_first") <= F.col("l_last"))
    met = a.withColumnRenamed("from", "l_from").hint("merge").join(b.withColumnRenamed("from", "r_from").hint("merge"), meet)
    return met.where(overlap & met_once).select(
        *[F.col(f"k{keys.index(c)}" if c in keys else f"l{i}").alias(c) for i, c in enumerate(left.columns)],
        *[F.col(f"r{i}").alias(c) for i, c in enumerate(right.columns) if c not in keys],
    )


def _spans(df: DataFrame, span: tuple[str, str], keys: Sequence[str], unit_seconds: int, letter: str) -> DataFrame:
    """Keys ``k0, ..``, the span in whole units as ``from`` and ``to``, as it is as ``l_first`` and ``l_last``, other columns as ``l0, ..``."""
    ends = [_unit(df, name, unit_seconds) for name in span]
    spans = df.select(
        *[column(k).alias(f"k{i}") for i, k in enumerate(keys)],
        ends[0].alias("from"), ends[1].alias("to"),
        column(span[0]).alias(f"{letter}_first"), column(span[1]).alias(f"{letter}_last"),
        *[column(c).alias(f"{letter}{i}") for i, c in enumerate(df.columns) if c not in keys],
        (column(span[0]) <= column(span[1])).alias("is_span"),
    )
    return spans.where("is_span").drop("is_span")


def _unit(df: DataFrame, name: str, unit_seconds: int) -> Column:
    match df.select(column(name).alias("c")).schema["c"].dataType:
        case IntegralType():
            return column(name).cast("long")
        case DateType():
            return F.unix_date(column(name)).cast("long")
        case TimestampType() | TimestampNTZType():
            micros = F.unix_micros(column(name).cast("timestamp"))
            return F.floor(micros / F.lit(unit_seconds * 1_000_000)).cast("long")
        case kind:
            raise JobError(f"overlap join: '{name}' is {kind.simpleString()}, not integer, date or timestamp")


def _level() -> Column:
    """The size of the largest bins that a span can hold."""
    return F.floor(F.log2(F.col("to") - F.col("from") + 1)).cast("int")


def _bin(level: Column, number: Column) -> Column:
    return F.struct(level.cast("int").alias("level"), number.cast("long").alias("bin"))


def _cover() -> Column:
    """The bins of the sizes 1, 2, 4, .. that make up a span: of a size at most one at either end."""

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        down = lambda point: F.call_function("shiftright", point, level)
        # In bins of this size, the first that starts within the span, and the first that ends behind it.
        low, high = down(F.col("from") + size - 1), down(F.col("to") + 1)
        odd = lambda number: F.pmod(number, F.lit(2)) == 1
        return F.array(F.when((low < high) & odd(low), _bin(level, low)), F.when((low < high) & odd(high), _bin(level, high - 1)))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), _level()), of)))


def _covers(spans: DataFrame) -> DataFrame:
    """A row for each bin of a span's cover."""
    return spans.select("*", F.inline(_cover()))


def _posted(spans: DataFrame, covers: int, starts: int, top: int) -> DataFrame:
    """Spans of ``many`` by the bins that cover them and those that hold their start, at levels from ``covers`` and ``starts``; others once."""
    cover = F.transform(_cover(), lambda b: _bin(b["level"] + covers, b["bin"]))
    held = F.transform(
        F.sequence(F.lit(0), F.lit(top)), lambda level: _bin(level + starts, F.call_function("shiftright", F.col("from"), level))
    )
    whole = F.array(_bin(F.lit(-1), F.lit(0)))
    return spans.select("*", F.inline(F.when(F.col("many"), F.concat(cover, held)).otherwise(whole))).drop("to", "many")
