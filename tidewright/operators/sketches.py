"""Sketches of batches that are kept and merged, so that no row is read twice.

A batch is summed up by ``sketch`` into a few kilobytes a group. States of many batches, stored
as any table, are put together by ``merge`` and read by ``estimate``. Merging gives the same bound on
the error as one sketch of all rows would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.errors import JobError
from tidewright.names import column

#: Registers of a count of distinct values, as a power of two, and size of a sketch of quantiles.
REGISTERS, QUANTILES_K = 12, 200

#: Within these, estimates are nearly always: three standard errors of a count, relative to it, and the
#: difference between the rank asked for and that of the value given, as a share of the rows.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.0265

_KINDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "distinct": (lambda v: F.hll_sketch_agg(v, REGISTERS), lambda s: F.hll_union_agg(s)),
    "quantiles": (
        lambda v: F.kll_sketch_agg_double(v.cast("double"), QUANTILES_K),
        lambda s: F.kll_merge_agg_double(s, QUANTILES_K),
    ),
}


def _kind(measures: Mapping[str, tuple[str, str]], name: str):
    kind = measures[name][0]
    if kind not in _KINDS:
        raise JobError(f"sketch '{name}': kinds are {sorted(_KINDS)}, not '{kind}'")
    return _KINDS[kind]


def sketch(df: DataFrame, group_by: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A row a group with a binary state for each measure: its kind, ``distinct`` or ``quantiles``, and SQL for the value.

    Nulls are left out; quantiles are those of the value as a double.
    """
    made = [_kind(measures, name)[0](F.expr(value)).alias(name) for name, (_, value) in measures.items()]
    return df.groupBy(*group_by).agg(*made)


def merge(states: DataFrame, group_by: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One state a group from those of several batches. A state that is null adds nothing."""
    return states.groupBy(*group_by).agg(*[_kind(measures, name)[1](column(name)).alias(name) for name in measures])


def estimate(
    states: DataFrame, group_by: Sequence[str], measures: Mapping[str, tuple[str, str]], shares: Sequence[float] = (0.5,)
) -> DataFrame:
    """What the states say: a count, or an array of the values at ``shares``; null where there were no values."""

    def read(name: str) -> Column:
        if measures[name][0] == "distinct":
            return F.hll_sketch_estimate(column(name))
        some = F.kll_sketch_get_n_double(column(name)) > 0
        return F.when(some, F.array(*[F.kll_sketch_get_quantile_double(column(name), F.lit(float(s))) for s in shares]))

    return states.select(*[column(c) for c in group_by], *[read(name).alias(name) for name in measures])
