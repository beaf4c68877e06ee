"""Chat formatting with Spark expressions only, and reading the format back.

A conversation becomes one text, in which blocks of one role follow each other:

    <|im_start|>role⏎text<|im_sep|>text<|im_end|>⏎

Turns next to each other with the same role share a block. ``<|`` inside a text is
written ``<\\|``, and ``<\\|`` with one more backslash, so that control strings stand
only where the template puts them and every text can be read back. The loss
mask is a list of run lengths: control, text, control, text, ..., control.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.names import column

START, SEP, END, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "<|>" else c for c in text)


def format_chats(
    df: DataFrame,
    *,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row a conversation: its identifier, ``formatted``, and ``mask``.

    ``mask`` is array<struct<length, loss>> over code points of ``formatted``; it
    covers it without gaps. Turns are sorted by number, null first; turns with
    equal numbers by role and text. A null text or role counts as empty; a null
    identifier is a conversation of its own; repeated rows are repeated turns.
    An empty table gives no rows. A conversation is one value of the result, so it
    has to fit into a task; its cost is in proportion to its length.
    """
    turn = F.struct(
        column(turn_column).alias("turn"),
        F.coalesce(column(role_column), F.lit("")).alias("role"),
        F.coalesce(column(text_column), F.lit("")).alias("text"),
    )
    turns = df.groupBy(column(id_column).alias(id_column)).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # Where blocks start: at turns whose role isn't the one before.
    starts = F.filter(
        F.transform(
            "turns",
            lambda t, i: F.when(
                (i == 0) | (F.get(F.col("turns"), i - 1)["role"] != t["role"]), i
            ),
        ),
        lambda i: i.isNotNull(),
    )
    blocks = F.transform(
        "starts",
        lambda start, j: F.struct(
            F.replace(escape(F.get(F.col("turns"), start)["role"]), F.lit("\n"), F.lit(LINE)).alias("role"),
            F.get(F.col("turns"), start)["role"].isin(*loss_roles).alias("loss"),
            F.transform(
                F.slice("turns", start + 1, F.coalesce(F.get(F.col("starts"), j + 1), F.size("turns")) - start),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    written = F.transform(
        "blocks",
        lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END)),
    )

    def head(block: Column) -> Column:
        return F.lit(len(START) + 1) + F.char_length(block["role"])

    def runs(block: Column, j: Column) -> Column:
        ended = F.when(j > 0, len(END)).otherwise(0)
        return F.flatten(
            F.transform(
                block["texts"],
                lambda text, i: F.array(
                    F.struct(
                        F.when(i == 0, ended + head(block)).otherwise(len(SEP)).cast("long").alias("length"),
                        F.lit(False).alias("loss"),
                    ),
                    F.struct(F.char_length(text).cast("long").alias("length"), block["loss"].alias("loss")),
                ),
            )
        )

    last = F.array(F.struct(F.lit(len(END)).cast("long").alias("length"), F.lit(False).alias("loss")))
    return (
        turns.withColumn("starts", starts)
        .withColumn("blocks", blocks)
        .select(
            id_column,
            F.array_join(written, "").alias("formatted"),
            F.concat(F.flatten(F.transform("blocks", runs)), last).alias("mask"),
        )
    )


def read_chats(df: DataFrame, *, id_column: str = "conv_id") -> DataFrame:
    """What ``formatted`` and ``mask`` say: ``turns`` (role, text) and ``loss_texts``.

    Raises if the lengths of the mask aren't those of the text.
    """
    blocks = F.split("formatted", _literal(END), -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    split_blocks = F.transform(
        blocks,
        lambda b: F.struct(
            F.substring_index(F.substring(b, len(START) + 1, 1 << 30), "\n", 1).alias("role"),
            F.split(F.regexp_replace(b, r"\A[^\n]*\n", ""), _literal(SEP), -1).alias("texts"),
        ),
    )
    read = F.flatten(
        F.transform(
            "split_blocks",
            lambda b: F.transform(
                b["texts"],
                lambda text: F.struct(
                    unescape(F.replace(b["role"], F.lit(LINE), F.lit("\n"))).alias("role"),
                    unescape(text).alias("text"),
                    F.char_length(text).cast("long").alias("length"),
                ),
            ),
        )
    )
    run = lambda i: F.get(F.col("mask"), 2 * i + 1)
    fits = (
        (F.size("mask") == 2 * F.size("turns") + 1)
        & F.forall(F.transform("turns", lambda t, i: t["length"] == run(i)["length"]), lambda ok: ok)
        & (F.aggregate("mask", F.lit(0).cast("long"), lambda a, r: a + r["length"]) == F.char_length("formatted"))
    )
    loss = F.filter(
        F.transform("turns", lambda t, i: F.when(run(i)["loss"], t["text"])), lambda text: text.isNotNull()
    )
    return (
        df.withColumn("split_blocks", split_blocks)
        .withColumn("turns", read)
        .select(
            id_column,
            "formatted",
            F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
            F.when(fits, loss).otherwise(F.raise_error(F.lit("the loss mask doesn't fit the text"))).alias("loss_texts"),
        )
    )
