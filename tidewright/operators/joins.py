"""Equi-join on columns both sides share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.errors import JobError
from tidewright.names import column, fold, has_unique_names, is_case_sensitive
from tidewright.operators.skew import hot_groups, small
from tidewright.work import fits_broadcast, stage

# Spark's names for join types.
_KINDS = {
    "inner": "inner",
    "cross": "cross",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "leftanti": "left_anti",
}


def join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join on ``on``; the key columns appear once, as with SQL's USING.

    Adaptive execution splits a hot key of an inner, semi or anti join and of
    the preserved side of an outer join. It cannot split the other side of an
    outer join, so hot keys are looked for there, and the rows that carry them
    go through an inner join instead. Without ``hot_rows`` a side that Spark
    would broadcast isn't counted.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not keys:
        raise JobError("join: 'on' is required")
    kind = _KINDS.get(how.lower().replace("_", ""))
    if kind is None:
        raise JobError(f"join: 'how' must be one of {sorted(_KINDS)}, not '{how}'")
    if kind not in ("left", "right", "full") or not (has_unique_names(left) and has_unique_names(right)):
        return left.join(right, on=keys, how=kind)
    if kind != "full" and hot_rows is None and fits_broadcast({"left": right, "right": left}[kind]):
        return left.join(right, on=keys, how=kind)
    names = [f"__hot{i}" for i in range(len(keys))]
    sides = {"left": [right], "right": [left], "full": [left, right]}[kind]
    found = [hot for side in sides if (hot := hot_groups(side, keys, names, "__hot_size", hot_rows))]
    if not found:
        return left.join(right, on=keys, how=kind)
    # Several parts read each side; they are to read files, not repeat all steps before.
    left, right = stage(left), stage(right)
    apart = []
    if kind == "full":
        # Rows whose key is NULL match nothing, yet all would meet in one task.
        both = (left, right)
        no_key = reduce(Column.__or__, [column(key).isNull() for key in keys])
        apart = [_alone(side.filter(no_key), both, at, keys) for at, side in enumerate(both)]
        left, right = left.filter(~no_key), right.filter(~no_key)
    # Of a full join the keys have a type both sides fit.
    typed = (left.join(right, on=keys, how=kind) if kind == "full" else sides[0]).select(*[column(k) for k in keys])
    cast = [F.col(name).cast(field.dataType).alias(name) for name, field in zip(names, typed.schema.fields)]
    listed = reduce(DataFrame.union, [hot.frame.select(*cast) for hot in found]).dropna().distinct()
    joined = _with_hot_keys_apart(left, right, keys, kind, listed, names, sum(hot.groups for hot in found))
    return reduce(DataFrame.union, apart, joined)


def _with_hot_keys_apart(
    left: DataFrame, right: DataFrame, keys: Sequence[str], kind: str, hot: DataFrame, names: Sequence[str], groups: int
) -> DataFrame:
    hot = small(hot, groups)

    def part(df: DataFrame, how: str) -> DataFrame:
        # A plain equality: rows whose key is NULL stay with the others.
        return df.join(hot, reduce(Column.__and__, [column(k) == column(n) for k, n in zip(keys, names)]), how)

    left_hot, right_hot = part(left, "left_semi"), part(right, "left_semi")
    result = part(left, "left_anti").join(part(right, "left_anti"), on=keys, how=kind)
    result = result.union(left_hot.join(right_hot, on=keys, how="inner"))
    if kind != "full":
        # Hot keys were counted on the side whose rows go only with a match.
        return result
    # Here a hot key may occur on one side alone. The lists of keys compared
    # are no longer than the list of hot keys.
    for at, (mine, other) in enumerate([(left_hot, right_hot), (right_hot, left_hot)]):
        alone = mine.join(small(other.select(*keys).distinct(), groups), on=keys, how="left_anti")
        result = result.union(_alone(alone, (left, right), at, keys))
    return result


def _alone(df: DataFrame, sides: Sequence[DataFrame], at: int, keys: Sequence[str]) -> DataFrame:
    """Rows of side ``at`` without a match, in the layout of the join."""
    exact = is_case_sensitive(df)
    shared = {fold(key, exact) for key in keys}
    rest = [
        column(field.name) if side == at else F.lit(None).cast(field.dataType).alias(field.name)
        for side, other in enumerate(sides)
        for field in other.schema.fields
        if fold(field.name, exact) not in shared
    ]
    return df.select(*[column(key) for key in keys], *rest)
