"""Connected components of a graph given by its links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewright.work import discard, stage


def _lowest(links: DataFrame) -> DataFrame:
    """For every node ``u`` with links, the lowest of itself and its neighbours."""
    return links.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("low"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the lowest node it is joined to, for the nodes of links ``u, v``.

    Every round hangs the larger neighbours of each node, then the smaller ones
    and itself, to its lowest neighbour, until nothing changes; the rounds grow with the logarithm of
    the nodes. Links are only ever replaced, so tables don't grow, and each round is
    staged. Loops and repeated links do no harm; links with a null are left out.
    """
    both = lambda df: df.select("u", "v").unionAll(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stage(links.select("u", "v").where("u <> v").distinct())
    state = None
    while True:
        marks = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (marks["n"], marks["h"]) == state:
            break
        state = marks["n"], marks["h"]
        around = both(edges)
        large = around.join(_lowest(around), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        low = _lowest(down)
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).unionAll(
            low.select("u", F.col("low").alias("v"))
        )
        edges, before = stage(small.where("u <> v").distinct()), edges
        discard(before)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
