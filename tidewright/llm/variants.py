"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words that one inserted, deleted or replaced code point tells apart, cut one into two
disjoint chunks: the edit leaves one of them whole, and the other word has it among its
positional grams, at the same place or one to the side. So every word is posted twice, as two
chunks and as grams (``near_words``), postings meet by gram and place, and pairs that meet are verified.
Each word then points to the most frequent near word that is far more frequent than itself
(``forms``), and pointers are followed to the end (``roots``). All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.names import column
from tidewright.work import stage

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Grams of one key above which it is split by a chunk of what the words have besides.
HOT_KEY = 64


def word_counts(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    every: int = 97,
    least_length: int = 5,
    least_count: int = 3,
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all texts, of words long and frequent enough.

    Words are maximal runs of Latin letters up to U+00FF, lower-cased from A to Z only. Where ``every``
    divides the CRC-32 h of ``<identifier>:<run>``, the run's code point h modulo its length is
    deleted first. A null text has no words, a null identifier reads as the empty string, repeated
    rows count each. Counts are summed in each task before they are shuffled by word.
    """
    run = F.col("run")
    runs = df.select(
        F.coalesce(column(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate(column(text_column), _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), run).cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length(run)).cast("int")
    edited = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    word = F.when(F.col("h") % every == 0, edited).otherwise(run)
    counted = hashed.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _head(text: Column, n: Column) -> Column:
    return F.substring(text, F.lit(1), n)


def _tail(text: Column, n: Column) -> Column:
    """The last ``n`` code points; none if ``n`` is 0."""
    return F.substring(text, F.char_length(text) - n + 1, n)


def _chunks(words: DataFrame, text: str, within: str | None = None) -> DataFrame:
    """The two disjoint chunks of ``text``, for a partner as long, one shorter and one longer.

    Each is half of it, the first at its beginning and the second at its end; that of the partner lies
    where the lengths say: the first at the same place, the second shifted by the difference. Adds
    ``gram``, ``q`` (its length), ``place`` (in the partner), ``partner`` (its length) and ``is_first``.
    """
    length = F.char_length(text)
    q = F.floor(length / 2).cast("int")
    shifts = F.array(*[F.lit(shift) for shift in (-1, 0, 1)])
    ends = F.array(F.lit(True), F.lit(False))
    posted = words.withColumn("shift", F.explode(shifts)) if within is None else words
    posted = posted.withColumns({"partner": length + F.col("shift"), "q": q, "is_first": F.explode(ends)})
    first = F.col("is_first")
    return posted.withColumns({
        "gram": F.when(first, _head(F.col(text), F.col("q"))).otherwise(_tail(F.col(text), F.col("q"))),
        "place": F.when(first, 0).otherwise(F.col("partner") - F.col("q")),
    })


def _grams(words: DataFrame, text: str) -> DataFrame:
    """The positional grams of ``text`` that a chunk of a word as long, one longer or one shorter can meet.

    A chunk meets grams of its own length within one place of where it lies; with both lengths
    known that place is certain, so that grams at others are left out: they would meet nothing.
    """
    length = F.char_length(text)
    posted = words.withColumn("shift", F.explode(F.array(*[F.lit(shift) for shift in (-1, 0, 1)])))
    posted = posted.withColumns({"partner": length, "q": F.floor((length - F.col("shift")) / 2).cast("int")})
    posted = posted.withColumn("place", F.explode(F.array(F.lit(0), F.col("partner") - F.col("q"))))
    return posted.withColumns({
        "is_first": F.col("place") == 0,
        "gram": F.substring(F.col(text), F.col("place") + 1, F.col("q")),
    })


_KEY = ["gram", "place", "partner", "shift"]


def near_words(words: DataFrame, *, hot_key: int = HOT_KEY) -> DataFrame:
    """Pairs ``word, near`` of distinct ``word`` values that one code point tells apart, each in both orders.

    Words need at least two code points; others are near nothing here. A key is a gram with its place
    and both lengths. Where more than ``hot_key`` grams have a key, what the words have besides the gram
    also differs by one edit, so its own two chunks split the key, and no more words meet than share three
    quarters of their code points. A pair is kept once, at its first common chunk. No partner is left out.
    """
    base = words.select("word").where(F.char_length("word") >= 2)
    chunks = _chunks(base, "word").where("partner >= 2")
    grams = _grams(base, "word").where(F.col("partner") - F.col("shift") >= 2).withColumnRenamed("word", "near")
    sizes = grams.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("grams")).where(F.col("grams") > hot_key)
    hot = stage(sizes.select(*_KEY))

    def split(postings: DataFrame, kind: str) -> DataFrame:
        return postings.join(hot, _KEY, kind)

    keep = ["word", "near", "is_first"]
    few = split(chunks, "left_anti").join(split(grams, "left_anti").drop("q", "is_first"), _KEY).select(*keep, "q")

    def besides(postings: DataFrame, name: str) -> DataFrame:
        """What a word has besides its gram; that lies at its beginning or at its end."""
        rest = F.char_length(name) - F.col("q")
        kept = F.when(F.col("place") == 0, _tail(F.col(name), rest)).otherwise(_head(F.col(name), rest))
        return postings.select(
            F.struct(*_KEY).alias("key"), F.col(name), F.col("is_first").alias("outer_first"), F.col("q").alias("outer_q"),
            "shift", kept.alias("rest"),
        )

    rest_chunks = _chunks(besides(split(chunks, "left_semi"), "word"), "rest", within="key")
    # The grams of a key are met by words of one length only, so that the length of their chunks is known.
    rest_grams = besides(split(grams, "left_semi"), "near")
    rest_q = F.floor((F.char_length("rest") - F.col("shift")) / 2).cast("int")
    rest_grams = rest_grams.withColumns({"q": rest_q, "is_first": F.explode(F.array(F.lit(True), F.lit(False)))})
    rest_grams = rest_grams.withColumns({
        "gram": F.when(F.col("is_first"), _head(F.col("rest"), F.col("q"))).otherwise(_tail(F.col("rest"), F.col("q"))),
        "other_rest": F.col("rest"),
    })
    many = (
        rest_chunks.join(rest_grams.select("key", "gram", "is_first", "near", "other_rest"), ["key", "gram", "is_first"])
        # At the first chunk of the rest that both have.
        .where(F.col("is_first") | (_head(F.col("rest"), F.col("q")) != _head(F.col("other_rest"), F.col("q"))))
        .select("word", "near", F.col("outer_first").alias("is_first"), F.col("outer_q").alias("q"))
    )
    met = few.unionByName(many).where(F.col("is_first") | (_head(F.col("word"), F.col("q")) != _head(F.col("near"), F.col("q"))))
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def forms(words: DataFrame, pairs: DataFrame, *, times: int = 2) -> DataFrame:
    """Every word with ``n_near``, and as ``form`` its near word of largest ``n``, with that ``n`` as ``form_n``.

    Ties go to the smaller word in code point order. There is no form unless its ``n`` is at
    least ``times`` that of the word.
    """
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = pairs.join(counts, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    return words.join(found, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(pointers: DataFrame) -> DataFrame:
    """``word`` and ``root``, where following ``form`` from it ends; pointers must not form a ring.

    Each round replaces a pointer by that of the word it points to, so that the
    rounds are the logarithm of the longest way. ``pointers`` has ``word`` and non-null ``form``.
    """
    current = stage(pointers.select("word", F.col("form").alias("root"), F.lit(False).alias("done")))
    while current.where("not done").limit(1).count():
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = stage(
            current.where("not done")
            .join(onward, "root", "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNull().alias("done"))
            .unionByName(current.where("done"))
        )
    return current.select("word", "root")


def spelling_variants(df: DataFrame, *, times: int = 2, hot_key: int = HOT_KEY, **settings) -> DataFrame:
    """Each word of ``word_counts`` with its form and root: ``word, form, root, n, n_near, form_n``.

    ``form`` and ``form_n`` are null where a word has no form; its root is then the word itself. As ``n``
    grows at every step, forms don't form rings. Other columns don't matter, whatever their
    names. No words give no rows. The text is read once; counts and what follows are staged.
    """
    words = stage(word_counts(df, **settings))
    formed = stage(forms(words, near_words(words, hot_key=hot_key), times=times))
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
