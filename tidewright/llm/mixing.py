"""Mix sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

All of it is DataFrame operations. The words of all documents are shared out to
the sources by weight (``targets``), the targets are turned into whole blocks by
the highest quotients (``apportion``), first over the sources, then over the
shards of each source, and every shard takes its blocks along a seeded order of
its documents, over and over if it owes more than it has (``mix``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.names import column
from tidewright.work import stage

# What counts as a word, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """The words each source owes to a mix as large as all sources together.

    ``sources`` has a row per source: ``source`` and ``source_size``. Weights
    repeat along the code point order of the names, null last. No source owes more
    than ``max_epochs`` times its size; what is over is shared among the others by
    weight until none is above. With the sources sorted by the level at which they
    fill up, that level is found in one pass. The windows run over one row a source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array([F.lit(w) for w in weights]), F.pmod(F.col("source_id") - 1, F.lit(len(weights))).cast("int") + 1
    )
    ranked = (
        sources.withColumn("source_id", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    )
    fills_at = F.col("cap") / F.col("weight")
    before = Window.orderBy(fills_at, "source_id").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = ranked.withColumn("level", level).withColumn("open", F.col("level") <= fills_at)
    # The first source, in the order of filling up, that its level doesn't fill.
    final = F.min_by("level", F.when(F.col("open"), F.struct(fills_at, F.col("source_id")))).over(everything)
    return levels.withColumn("target", F.least(final * F.col("weight"), F.col("cap"))).drop("level", "open", "cap")


def apportion(cells: DataFrame, key: Sequence[str], group: Sequence[str], votes: str, seats: str) -> DataFrame:
    """Give each group's ``seats`` to its cells by the highest quotients votes / (2k + 1).

    Adds ``quota``. Only quotients near the last seat are ranked: a cell surely has
    the seats it gets at the divisor V / (seats - n/2), and never more than at
    V / (seats + n/2), for n cells with V votes together; that leaves about three
    quotients a cell. Ties go to the smaller ``key``.
    """
    whole = Window.partitionBy(*group)
    all_votes, cells_in = F.sum(votes).over(whole), F.count(F.lit(1)).over(whole)

    def seats_at(total: Column) -> Column:
        return F.floor(F.when(all_votes > 0, F.col(votes) * total / all_votes).otherwise(0.0) + 0.5)

    # One more either way, for what floating point may lose.
    low = F.greatest(seats_at(F.greatest(F.col(seats) - cells_in / 2, F.lit(0.0))) - 1, F.lit(0)).cast("long")
    high = (seats_at(F.col(seats) + cells_in / 2) + 1).cast("long")
    bounds = cells.withColumns({"sure": low, "last": high})
    quotients = bounds.withColumn("left", F.col(seats) - F.sum("sure").over(whole)).withColumn(
        "k", F.explode(F.sequence("sure", "last"))
    )
    best = Window.partitionBy(*group).orderBy((F.col(votes) / (2 * F.col("k") + 1)).desc(), *key)
    won = quotients.withColumn("won", (F.row_number().over(best) <= F.col("left")).cast("long"))
    kept = [name for name in cells.columns if name not in key]
    return won.groupBy(*key).agg(
        *[F.first(name).alias(name) for name in kept], (F.first("sure") + F.sum("won")).alias("quota")
    )


def mix(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    carry: Sequence[str] = (),
    weights: Sequence[int] = (5, 2, 1),
    max_epochs: int = 3,
    block_words: int = 32,
    shard_rows: int = 20_000,
    seed: str = "mix",
) -> DataFrame:
    """How many words a mix of all sources takes from each row.

    Returns the identifier, ``size`` (words of the text, 0 for null or blank text),
    ``source_size``, ``target`` (of the source), ``taken`` (words the mix takes,
    repeats counted, at most ``max_epochs`` times the size) and, as the struct
    ``carried``, the columns in ``carry``. There is a row out for each row in.

    A source is dealt into shards of about ``shard_rows`` rows by a seeded digest of
    the identifier, so that a hot source is many shards. A shard owing q blocks
    of ``block_words`` takes its documents in the order of that digest, all of them as
    often as they fit and then as many as are left, so that at most one document
    of a shard is taken in part. Sizes are counted once and staged.

    Null sources are a source of their own, the last one. Rows that are equal,
    and rows with a null identifier, count each by itself; the latter are in one
    shard. Other columns don't matter, whatever their names. An empty table gives no rows.
    """
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(column(id_column).cast("string"), F.lit(""))))
    rows = stage(
        df.select(
            column(id_column).alias("id"),
            column(source_column).alias("source"),
            word_count(column(text_column)).alias("size"),
            digest.alias("digest"),
            *([F.struct(*[column(name) for name in carry]).alias("carried")] if carry else []),
        )
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    owed = targets(totals, weights, max_epochs).withColumn(
        "seats", F.floor(F.sum("source_size").over(Window.partitionBy()) / block_words + 0.5)
    )
    # All sources are one group; a constant key keeps apportion general.
    sources = stage(
        apportion(owed.withColumn("all", F.lit(1)), ["source_id"], ["all"], "target", "seats")
        .withColumn("n_shards", F.ceil(F.col("n_rows") / shard_rows))
        .select("source_id", "source", "source_size", "target", "quota", "n_shards")
    )
    number = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    dealt = rows.join(
        sources.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))
    ).withColumn("shard", number % F.col("n_shards"))
    sizes = dealt.groupBy("source_id", "shard").agg(
        F.sum("size").cast("double").alias("shard_size"), F.first("quota").alias("seats")
    )
    shards = stage(
        apportion(sizes, ["source_id", "shard"], ["source_id"], "shard_size", "seats").select(
            F.col("source_id").alias("of"),
            F.col("shard").alias("within"),
            F.col("shard_size").cast("long").alias("shard_size"),
            F.least(F.col("quota") * block_words, F.col("shard_size").cast("long") * max_epochs).alias("owes"),
        )
    )
    order = Window.partitionBy("source_id", "shard").orderBy("digest", "id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.withColumn("before", before).join(
        shards, (F.col("source_id") == F.col("of")) & (F.col("shard") == F.col("within"))
    )
    rounds = F.when(F.col("shard_size") > 0, F.expr("owes div shard_size")).otherwise(0)
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("owes") - rounds * F.col("shard_size") - F.col("before")))
    return placed.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (rounds * F.col("size") + rest).cast("long").alias("taken"),
        *(["carried"] if carry else []),
    )


def mixed_rows(df: DataFrame, *, columns: Sequence[str], text_column: str = "text", **settings) -> DataFrame:
    """The mix itself: a row for each time a document is taken.

    Whole takes are the rows as they were; a document taken in part comes as its first
    words, joined by single spaces. Documents that give no word are left out.
    """
    taken = mix(df, text_column=text_column, carry=columns, **settings).where("taken > 0")
    copies = taken.withColumn("words", F.explode(F.expr(
        "concat(array_repeat(size, int(taken div size)), if(taken % size > 0, array(taken % size), array()))"
    )))
    text = F.col("carried")[text_column]
    words = F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), 1, F.col("words").cast("int"))
    cut = F.when(F.col("words") < F.col("size"), F.array_join(words, " ")).otherwise(text)
    return copies.select(*[(cut if c == text_column else F.col("carried")[c]).alias(c) for c in columns])
