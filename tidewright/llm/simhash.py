"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius.

All of it is DataFrame operations. Every term of a text votes on 128 signed bits
with the bits of its hash and with its weight; a bit is set if the votes for it
are more than half. Fingerprints within a radius of each other are found by
permuted block tables: of ``radius + key_blocks`` blocks at most ``radius`` differ, so
some ``key_blocks`` of them are equal, and each choice of blocks is a table to join on.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewright.names import column
from tidewright.work import stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
# Vote counts in the quarters and in the halves of a long. As the quarters hold 15 bits
# safely, terms of weight 15 at most are first counted in pieces of 2048.
_QUARTERS, _HALVES = 0x0001000100010001, 0x0000FFFF0000FFFF
_PIECE_BITS, _MOST_WEIGHT = 11, 15


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def fingerprints(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """``high`` and ``low``, the halves of each text's fingerprint, by ``key``.

    A term is a pair of neighbouring lower-case words (the last word stands alone), and
    its weight is how often it occurs times the code points of its words, 15 at most.
    A text without words has fingerprint 0. The keys have to tell rows apart. If the rows
    lie together by some of the keys, they aren't shuffled again. Votes end up in
    32 bits, enough for texts of 10^8 terms.
    """
    words = texts.select(*key, _words(F.col(text)).alias("_words"))
    pairs = words.select(
        *key, F.posexplode_outer(F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, 2**31 - 1).alias("b")))
    ).select(*key, F.shiftright("pos", _PIECE_BITS).alias("_piece"), "col.a", "col.b")
    weight = F.least(F.char_length("a") + F.coalesce(F.char_length("b"), F.lit(0)), F.lit(_MOST_WEIGHT)).cast("long")
    first = F.xxhash64("a", "b")
    votes = pairs.select(
        *key,
        "_piece",
        F.when(F.col("a").isNotNull(), weight).otherwise(F.lit(0).cast("long")).alias("_weight"),
        first.alias("_h0"),
        F.xxhash64(F.lit(1), first).alias("_h1"),
    )
    by_piece = votes.groupBy(*key, "_piece").agg(
        F.sum("_weight").alias("_total"),
        *[
            F.sum(F.shiftright(f"_h{half}", bit).bitwiseAND(F.lit(_QUARTERS)) * F.col("_weight")).alias(f"_q{half}_{bit}")
            for half in (0, 1)
            for bit in range(16)
        ],
    )
    counted = by_piece.groupBy(*key).agg(
        F.sum("_total").alias("_total"),
        *[
            F.sum(F.shiftright(f"_q{half}_{bit % 16}", bit // 16 * 16).bitwiseAND(F.lit(_HALVES))).alias(f"_v{half}_{bit}")
            for half in (0, 1)
            for bit in range(32)
        ],
    )

    def half(number: int) -> Column:
        bits = F.lit(0).cast("long")
        for bit in range(32):
            lane = F.col(f"_v{number}_{bit}")
            for count, place in ((lane.bitwiseAND(F.lit(0xFFFFFFFF)), bit), (F.shiftrightunsigned(lane, 32), bit + 32)):
                mask = (1 << place) - (1 << 64 if place == 63 else 0)
                bits = bits.bitwiseOR(F.when(2 * count > F.col("_total"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
        return bits

    return counted.select(*key, half(1).alias("high"), half(0).alias("low"))


def likeness(high_a: Column, low_a: Column, high_b: Column, low_b: Column) -> Column:
    """The share of equal bits."""
    return 1 - distance(high_a, low_a, high_b, low_b) / F.lit(128.0)


def distance(high_a: Column, low_a: Column, high_b: Column, low_b: Column) -> Column:
    return F.bit_count(high_a.bitwiseXOR(high_b)) + F.bit_count(low_a.bitwiseXOR(low_b))


def as_text(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def within_radius(prints: DataFrame, radius: int = 6, key_blocks: int = 2) -> DataFrame:
    """All pairs of different fingerprints at most ``radius`` bits apart, each once.

    ``prints`` has ``high`` and ``low``; repeated ones count once, so copies make
    no pairs. Returns ``high_a, low_a, high_b, low_b, bits``. More ``key_blocks``
    mean longer keys and more tables: with n fingerprints a key should have
    well over log2(n) bits; it has 128 * key_blocks / (radius + key_blocks).
    """
    blocks = radius + key_blocks
    edges = [128 * i // blocks for i in range(blocks + 1)]

    def block(low_edge: int, high_edge: int, high: Column, low: Column) -> list[Column]:
        parts = []
        for half, start in ((low, 0), (high, 64)):
            a, b = max(low_edge, start) - start, min(high_edge, start + 64) - start
            if a < b:
                mask = ((1 << (b - a)) - 1) << a
                mask -= 1 << 64 if mask >> 63 else 0
                parts.append(half.bitwiseAND(F.lit(mask).cast("long")))
        return parts

    cuts = list(zip(edges, edges[1:]))
    own = [block(*cut, F.col("high"), F.col("low")) for cut in cuts]
    tables = F.array([
        F.struct(
            F.lit(sum(1 << i for i in choice)).alias("chosen"),
            F.xxhash64(F.lit(n), *[part for i in choice for part in own[i]]).alias("key"),
        )
        for n, choice in enumerate(combinations(range(blocks), key_blocks))
    ])
    posted = prints.select("high", "low").distinct().select("high", "low", F.inline(tables))
    a = posted.select(F.col("high").alias("high_a"), F.col("low").alias("low_a"), "chosen", "key")
    b = posted.select(F.col("high").alias("high_b"), F.col("low").alias("low_b"), "chosen", "key")
    bits = distance(F.col("high_a"), F.col("low_a"), F.col("high_b"), F.col("low_b"))
    ordered = (F.col("high_a") < F.col("high_b")) | (
        (F.col("high_a") == F.col("high_b")) & (F.col("low_a") < F.col("low_b"))
    )
    # A pair that meets in several tables is kept in that of its first equal blocks.
    apart = F.col("high_a").bitwiseXOR(F.col("high_b")), F.col("low_a").bitwiseXOR(F.col("low_b"))
    same = F.lit(0)
    for i, cut in enumerate(cuts):
        is_equal = F.lit(True)
        for part in block(*cut, *apart):
            is_equal = is_equal & (part == 0)
        same = same + F.when(is_equal, 1 << i).otherwise(0)
    first, rest = F.lit(0), F.col("same")
    for _ in range(key_blocks):
        lowest = rest.bitwiseAND(-rest)
        first, rest = first.bitwiseOR(lowest), rest.bitwiseXOR(lowest)
    # Spark takes the tables for as small as the fingerprints and would collect one of the sides on the driver.
    return (
        a.hint("merge").join(b.hint("merge"), ["chosen", "key"])
        .where(ordered & (bits <= radius))
        .withColumn("same", same)
        .where(F.col("chosen") == first)
        .select("high_a", "low_a", "high_b", "low_b", bits.alias("bits"))
    )


def next_to(
    df: DataFrame, id_column: str, text_column: str, bucket_rows: int = 2_000, most_buckets: int = 10_000
) -> DataFrame:
    """Every row beside the next one's text, by descending identifier, in one shuffle.

    Returns ``bucket, place, guard, id, text, next_text``. The identifiers are cut into
    buckets of about ``bucket_rows`` at values that occur (a scan of that column), of more rows
    where there would be over ``most_buckets``, as the bounds are part of the plan; a bucket is sorted on disk. The
    largest row of a bucket is also put, as a guard, behind the last one of the
    bucket above, so that no row needs a neighbour elsewhere. After the last row comes the first.
    Null identifiers come last; rows with equal ones are ordered by text.
    """
    ids = df.select(column(id_column).cast("long").alias("id"))
    # Bounds are one number for each bucket, however many rows there are.
    n_rows = ids.count()
    pieces = min(most_buckets, max(1, math.ceil(n_rows / bucket_rows)))
    shares = [i / pieces for i in range(1, pieces)] + [1.0]
    found = ids.agg(
        F.percentile_approx("id", shares, max(10_000, 4 * pieces)).alias("at"), F.max("id").alias("most")
    ).first()
    bounds = sorted({*(found["at"] or []), found["most"]} - {None})
    rows = df.select(column(id_column).cast("long").alias("id"), F.coalesce(column(text_column), F.lit("")).alias("text"))
    if bounds:
        # The bound that an identifier belongs to, looked up in two steps of about the square root.
        step = math.isqrt(len(bounds)) + 1
        chunks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
        longs = lambda values: F.array([F.lit(v).cast("long") for v in values])
        below = lambda values: F.size(F.filter(values, lambda v: v < F.col("id")))
        rows = rows.withColumn("chunk", F.coalesce(below(longs([c[-1] for c in chunks])), F.lit(0)))
        rows = rows.withColumn("bounds", F.get(F.array([longs(c) for c in chunks]), F.col("chunk")))
        rows = rows.withColumn("fine", F.when(F.col("id").isNull(), 0).otherwise(below(F.col("bounds"))))
        rows = rows.withColumn("bucket", F.col("chunk") * step + F.col("fine"))
        here = F.struct("bucket", F.lit(False).alias("guard"))
        above = F.struct(((F.col("bucket") + 1) % len(bounds)).alias("bucket"), F.lit(True).alias("guard"))
        is_bound = F.get("bounds", F.col("fine")) == F.col("id")
        rows = rows.select("id", "text", F.inline(F.when(is_bound, F.array(here, above)).otherwise(F.array(here))))
    else:
        rows = rows.select("id", "text", F.lit(0).alias("bucket"), F.lit(False).alias("guard"))
    order = Window.partitionBy("bucket").orderBy("guard", F.col("id").desc_nulls_last(), "text")
    following = F.lead("text").over(order)
    if not bounds:
        following = F.coalesce(following, F.first("text").over(order))
    return rows.select("*", F.row_number().over(order).alias("place"), following.alias("next_text"))


def edited(text: Column, next_text: Column) -> Column:
    """The last half of the code points replaced by as many of the next text, or all it has."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(next_text, half))


def fingerprint_edits(
    df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", radius: int = 6
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are.

    Returns the identifier, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and ``n_near``, the number of other
    fingerprints of texts within ``radius`` bits. A row out for each row in. A null text
    counts as empty; order and repeated identifiers are as in ``next_to``; other
    columns don't matter. An empty table gives no rows.
    """
    rows = next_to(df, id_column, text_column).withColumn(
        "edited_text", F.when(~F.col("guard"), edited(F.col("text"), F.col("next_text")))
    )
    key = ["bucket", "place", "guard", "id", "n_chars", "edited_sha256"]
    both = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("kind"), F.col("edited_text").alias("body")),
    )
    bodies = rows.select(
        "bucket", "place", "guard", "id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"), F.inline(both),
    ).where("body IS NOT NULL")
    prints = fingerprints(bodies, [*key, "kind"], "body")
    of_kind = lambda kind, half: F.max(F.when(F.col("kind") == kind, F.col(half)))
    pairs = prints.groupBy(*key).agg(
        of_kind(0, "high").alias("high"), of_kind(0, "low").alias("low"),
        of_kind(1, "high").alias("edited_high"), of_kind(1, "low").alias("edited_low"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    beside = pairs.select(
        "*",
        F.coalesce(F.lead("high").over(order), F.first("high").over(order)).alias("next_high"),
        F.coalesce(F.lead("low").over(order), F.first("low").over(order)).alias("next_low"),
    ).where(~F.col("guard"))
    staged = stage(beside.drop("bucket", "place", "guard"))
    links = within_radius(staged, radius)
    ends = links.select(F.col("high_a").alias("high"), F.col("low_a").alias("low")).unionAll(
        links.select("high_b", "low_b")
    )
    near = ends.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_near"))
    return staged.join(near, ["high", "low"], "left").select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        as_text(F.col("high"), F.col("low")).alias("fingerprint"),
        as_text(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"),
        likeness(F.col("high"), F.col("low"), F.col("edited_high"), F.col("edited_low")).alias("near_edited"),
        likeness(F.col("high"), F.col("low"), F.col("next_high"), F.col("next_low")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
