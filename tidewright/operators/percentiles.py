"""Exact percentiles of groups of any size.

Spark's own percentile keeps the distinct values of a group in one task. Here the value at a
rank is searched for by rounds: the range it must lie in is cut into equal bins, the rows of
each bin are counted, and the bin with the rank in it is the next range. Counts are summed in each
task before they are shuffled, so that no group is ever gathered or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.errors import JobError
from tidewright.names import Expression, column, expression as to_column, unused
from tidewright.operators.skew import same_keys, small
from tidewright.work import stage

#: Bins a range is cut into in each round.
BINS = 1_024


def exact_percentiles(
    df: DataFrame,
    value: Expression,
    percentages: Sequence[float],
    group_by: Sequence[str] = (),
    *,
    bins: int = BINS,
) -> DataFrame:
    """A row a group: its keys and ``percentiles``, an array of doubles in the order of ``percentages``.

    The same numbers as Spark's ``percentile``: between two ranks it is interpolated, nulls are left
    out, NaN is larger than all numbers, and a group without values has a null. NULL keys are a group.
    The keys and the value, as a double, are staged and read once a round; a round narrows
    the range by the number of bins, so that a handful finds any rank of evenly spread values.
    Ranges of very different sizes are cut by the logarithm. Without ``group_by`` there is one
    row, also of an empty table.
    """
    if not percentages or any(not 0 <= p <= 1 for p in percentages):
        raise JobError(f"percentiles: from 0 to 1, not {list(percentages)}")
    keys = [f"__key{i}" for i in range(len(group_by))]
    rows = stage(
        df.select(*[column(name).alias(key) for name, key in zip(group_by, keys)], to_column(df, value).cast("double").alias("v"))
    )
    v, inf = F.col("v"), F.lit(float("inf"))
    finite = ~F.isnan(v) & (F.abs(v) < inf)
    groups = stage(
        rows.groupBy(*keys).agg(
            F.count("v").alias("n"),
            F.count_if(v == -inf).alias("n_low"),
            F.count_if(finite).alias("n_finite"),
            F.count_if(v == inf).alias("n_high"),
            F.min(F.when(finite, v)).alias("lo"),
            F.max(F.when(finite, v)).alias("hi"),
        )
    )
    n_groups = groups.count()
    places = F.array(*[(F.col("n") - 1) * F.lit(float(p)) for p in percentages])
    wanted = groups.where("n > 0").withColumn("places", places)
    ranks = F.array_distinct(F.flatten(F.transform("places", lambda p: F.array(F.floor(p), F.ceil(p)))))
    ranked = wanted.withColumn("rank", F.explode(ranks))
    # Ranks among the finite values; what lies outside them is known already.
    at = F.col("rank") - F.col("n_low")
    outside = (
        F.when(at < 0, -inf)
        .when(at >= F.col("n_finite") + F.col("n_high"), F.lit(float("nan")))
        .when(at >= F.col("n_finite"), inf)
    )
    found = outside.isNotNull()
    state = stage(
        ranked.select(
            *keys,
            "rank",
            at.alias("at"),
            F.lit(0).cast("long").alias("below"),
            F.when(found, outside).otherwise(F.col("lo")).alias("lo"),
            F.when(found, outside).otherwise(F.col("hi")).alias("hi"),
        )
    )
    n_states = 2 * len(percentages) * n_groups
    while state.where("lo < hi").limit(1).count():
        state = stage(_narrowed(rows, state, keys, bins, n_states))

    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "lo")))
    # At most two ranks a percentage.
    values = state.groupBy(*keys).agg(by_rank.alias("at_rank"))
    others = [f"__other{i}" for i in range(len(keys))]
    values = values.select(*[F.col(k).alias(o) for k, o in zip(keys, others)], "at_rank")
    # All keys of both sides are the groups of one aggregation.
    joined = groups.withColumn("places", places).join(small(values, n_groups), same_keys(keys, others), "left")

    def between(place: Column) -> Column:
        low, high = F.floor(place), F.ceil(place)
        a, b = F.element_at("at_rank", low), F.element_at("at_rank", high)
        return F.when((low == high) | (a == b), a).otherwise((high - place) * a + (place - low) * b)

    result = F.when(F.col("n") > 0, F.transform("places", between))
    return joined.select(*[F.col(k).alias(name) for k, name in zip(keys, group_by)], result.alias("percentiles"))


def _narrowed(rows: DataFrame, state: DataFrame, keys: Sequence[str], bins: int, n_states: int) -> DataFrame:
    """For every open range, the range of values in the bin that holds the rank."""
    open_ = state.where("lo < hi")
    ours = [unused(f"{k}_of", [*state.columns, *rows.columns]) for k in keys]
    asked = open_.select(*[F.col(k).alias(o) for k, o in zip(keys, ours)], "rank", "lo", "hi")
    inside = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")) & same_keys(keys, ours)
    met = rows.join(small(asked, n_states), inside)
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    wide = hi / 2 - lo / 2 > 1e4 * (1 + F.least(F.abs(lo), F.abs(hi)))
    curve = [F.when(wide, F.signum(x) * F.log1p(F.abs(x))).otherwise(x) for x in (v, lo, hi)]
    share = F.when(curve[2] > curve[1], (curve[0] - curve[1]) / (curve[2] - curve[1]))
    # The least value is in the first bin and the largest in the last, so that each round makes way.
    bin_ = F.when(v == lo, 0).when(v == hi, bins - 1).otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.5)) * bins), F.lit(bins - 1)))
    counted = met.groupBy(*ours, "rank", bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("least"), F.max("v").alias("most")
    )
    counted = counted.select(*[F.col(o).alias(k) for k, o in zip(keys, ours)], F.col("rank").alias("rank_of"), "bin", "rows", "least", "most")
    names = [f"{k}_in" for k in keys]
    binned = counted.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "rank_of", "bin", "rows", "least", "most")
    # One row a bin: no more than the bins of each rank.
    before = Window.partitionBy(*names, "rank_of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    summed = binned.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    joined = open_.join(summed, same_keys([*keys, "rank"], [*names, "rank_of"]))
    place = F.col("at") - F.col("below")
    holds = (place >= F.col("before")) & (place < F.col("before") + F.col("rows"))
    narrowed = joined.where(holds).select(
        *keys, "rank", "at", (F.col("below") + F.col("before")).alias("below"), F.col("least").alias("lo"), F.col("most").alias("hi")
    )
    return narrowed.unionByName(state.where("not (lo < hi)"))
