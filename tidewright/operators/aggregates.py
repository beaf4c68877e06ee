"""Grouped and global aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewright.errors import JobError
from tidewright.names import Expression, expression, unused
from tidewright.operators.percentiles import exact_percentiles
from tidewright.operators.skew import hot_groups, same_keys, small
from tidewright.operators.windows import function_call
from tidewright.work import is_repeatable, stage


def aggregate(
    df: DataFrame,
    group_by: Sequence[str] = (),
    aggs: Mapping[str, Expression] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Group columns first, then the aggregates in order of their aliases.

    Spark aggregates within each input partition before it shuffles, so a
    group holding a large share of the rows costs no more than any other. Medians and
    exact percentiles are different, as Spark keeps all values of a group in one task: where one is asked for, groups
    are counted, and those of groups over ``hot_rows`` rows are searched for by rounds of counts instead.
    """
    if not aggs:
        raise JobError("aggregate: 'aggs' is required; use distinct in a sql step to list groups")
    percentiles = {alias: found for alias in aggs if (found := _percentile(aggs[alias])) is not None}
    if percentiles and set(group_by) <= set(df.columns):
        return _with_hot_groups(df, list(group_by), aggs, percentiles, hot_rows)
    return _plain(df, group_by, aggs)


def _plain(df: DataFrame, group_by: Sequence[str], aggs: Mapping[str, Expression]) -> DataFrame:
    return df.groupBy(*group_by).agg(*[expression(df, aggs[alias]).alias(alias) for alias in sorted(aggs)])


def _percentile(text: Expression) -> tuple[str, float] | None:
    """The value and the share, if ``text`` is the call of an exact percentile."""
    call = function_call(text) if isinstance(text, str) else None
    if call is None or call.condition or call.ignores_nulls:
        return None
    match call.function, call.arguments:
        case "median", [value]:
            return value, 0.5
        case "percentile", [value, share] if share.replace(".", "", 1).isdigit():
            return value, float(share)
    return None


def _with_hot_groups(
    df: DataFrame, group_by: list[str], aggs: Mapping[str, Expression], percentiles: Mapping[str, tuple[str, float]], hot_rows: int | None
) -> DataFrame:
    df = df if is_repeatable(df) else stage(df)
    plain = _plain(df, group_by, aggs)
    names = [unused(f"__hot{i}", df.columns) for i in range(len(group_by))]
    found = hot_groups(df, group_by, names, unused("__rows", df.columns), hot_rows)
    kinds = df.select(*[expression(df, value).alias(alias) for alias, (value, _) in percentiles.items()]).schema
    if found is None or any("interval" in field.dataType.simpleString() for field in kinds):
        return plain
    hot = small(found.frame.select(*names), found.groups)
    rows = df.join(hot, same_keys(group_by, names), "left_semi") if group_by else df
    others = {alias: text for alias, text in aggs.items() if alias not in percentiles} or {unused("__n", aggs): "count(*)"}
    result = _plain(rows, group_by, others)
    by_value: dict[str, list[str]] = {}
    for alias, (value, _) in percentiles.items():
        by_value.setdefault(value, []).append(alias)
    values = {}
    for at, (value, aliases) in enumerate(by_value.items()):
        keys = [unused(f"__of{at}_{i}", result.columns) for i in range(len(group_by))]
        array = unused(f"__percentiles{at}", result.columns)
        searched = exact_percentiles(rows, value, [percentiles[a][1] for a in aliases], group_by).toDF(*keys, array)
        result = result.join(small(searched, found.groups), same_keys(group_by, keys)).drop(*keys)
        values.update({alias: F.get(F.col(array), i) for i, alias in enumerate(aliases)})
    ordered = [values[a].alias(a) if a in values else F.col(f"`{a}`") for a in sorted(aggs)]
    result = result.select(*group_by, *ordered)
    if not group_by:
        return result
    return _plain(df.join(hot, same_keys(group_by, names), "left_anti"), group_by, aggs).unionByName(result)
