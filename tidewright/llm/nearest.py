"""Approximate nearest neighbours with a permutation index.

A vector stands for the order in which it sees its nearest pivots. Vectors are dealt
into shards; in each, the orders are posted in pivot inverted files: for every pivot the
rows that have it among their nearest, and at which place. A block of queries meets a
shard: the files of a query's pivots give the footrule distance to the shard's
rows, the best share of them is reranked by exact cosine, and the shards' best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidewright.names import column
from tidewright.work import stage


def _nearest_pivots(unit: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """For each row the numbers of its nearest pivots, nearest first."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :length]


def _units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def search_shard(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, pivots: np.ndarray,
    *, length: int, share: float, least: int, k: int,
) -> list[tuple[int, int, float]]:
    """(query, row, cosine): each query's ``k`` best of the rows that its footrule order puts first."""
    units, wanted = _units(rows), _units(queries)
    order = _nearest_pivots(units, pivots, length)
    # The inverted files: rows by pivot, with their weight, length minus place.
    flat = order.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    starts = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))
    posted, weight = by_pivot // order.shape[1], length - by_pivot % order.shape[1]
    count = min(len(rows), max(least, math.ceil(share * len(rows))))
    found = []
    for query, own_id, own in zip(wanted, query_ids.tolist(), _nearest_pivots(wanted, pivots, length)):
        slices = [slice(starts[p], starts[p + 1]) for p in own]
        sizes = [s.stop - s.start for s in slices]
        hit = np.concatenate([posted[s] for s in slices])
        # With a missing pivot at place `length`, the footrule distance is a constant less twice
        # the sum, over shared pivots, of the smaller weight.
        shared = np.minimum(np.concatenate([weight[s] for s in slices]), np.repeat(length - np.arange(len(own)), sizes))
        near = np.bincount(hit, shared, len(rows))
        best = np.argpartition(-near, count - 1)[:count]
        best = best[row_ids[best] != own_id]
        # Summed row by row, so that equal vectors have equal cosines wherever they stand.
        cosine = (units[best] * query).sum(axis=1)
        top = np.lexsort((row_ids[best], -cosine))[:k]
        found += [(own_id, int(row_ids[best[i]]), float(cosine[i])) for i in top]
    return found


def nearest(
    df: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    is_query: str = "{id} % 50 = 0",
    k: int = 5,
    pivots: int = 1_024,
    length: int = 64,
    share: float = 0.08,
    least: int = 512,
    shard_rows: int = 8_192,
    block_queries: int = 2_048,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every query, by cosine.

    Queries are the rows for which ``is_query`` holds; candidates are all rows of
    other identifiers. The index is fitted to ``pivots`` rows, chosen by a hash (a quarter of the rows if they are
    few), and holds every row; of each shard the best ``share`` by footrule, ``least`` at
    least, is reranked, so shards of no more rows than that are searched exactly.
    Ties go to the smaller identifier; fewer candidates than ``k`` are all returned.
    Vectors that are null, empty or zero, or hold a null or non-finite component, and
    rows with a null identifier take no part. Only vectors of one dimension meet. Of query rows with the
    same identifier the smallest vector is searched. An empty table gives no rows.
    """
    doubles = column(vector_column).cast("array<double>")
    valid = (
        F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists(doubles, lambda x: x != 0)
        & column(id_column).isNotNull()
    )
    rows = stage(
        df.where(valid).select(column(id_column).cast("long").alias("id"), doubles.alias("vector")).withColumn(
            "dims", F.size("vector")
        )
    )
    asked = rows.where(is_query.format(id="id")).groupBy("id", "dims").agg(F.min("vector").alias("vector"))
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    chosen = Window.partitionBy("dims").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    sample = rows.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= pivots)
    # Bounded by the number of pivots for each dimension.
    fitted: dict[int, np.ndarray] = {}
    n_rows = {row["dims"]: row["n"] for row in sizes.collect()}
    for dims, own in sample.orderBy("place").select("dims", "vector").toPandas().groupby("dims"):
        few = min(pivots, max(16, n_rows[dims] // 4))
        fitted[int(dims)] = _units(np.stack(own["vector"].to_numpy()[:few]))
    shards = max(1, math.ceil(sum(n_rows.values()) / shard_rows))
    blocks = max(1, math.ceil(asked.count() / block_queries))
    shared = df.sparkSession.sparkContext.broadcast(fitted)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", each(shards))
    right = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("block", each(blocks))

    def search(key: tuple, queries: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(own):
            own = own.sort_values("id")
            found = search_shard(
                np.stack(queries["vector"].to_numpy()), queries["id"].to_numpy(), np.stack(own["vector"].to_numpy()),
                own["id"].to_numpy(), shared.value[int(key[0])], length=length, share=share, least=least, k=k,
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    key = ["dims", "block", "shard"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("vec_id").alias(id_column), "score"
    )
