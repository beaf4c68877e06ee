"""Finding and masking personal data in text columns.

Everything is a native column expression over whole texts, at any depth of
nesting: no Python runs per row, and columns without text stay untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, CharType, DataType, MapType, StringType, StructType, VarcharType

from tidewright.errors import JobError
from tidewright.names import column

MASK = "****"

DETECTED = "DetectedEntities"

# Word boundaries in ASCII, spelled out so that accented letters count as
# anything else does. Looking for a digit first is what makes the search quick:
# most places in a text are passed over for that.
_BEFORE, _AFTER = r"(?=[0-9])(?<![0-9A-Za-z_])", r"(?![0-9A-Za-z_])"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# The entities, in the order they are masked, and what each looks
# like. Text masked for one entity is not looked at for the next.
ENTITIES = ("EMAIL", "USA_SSN", "CREDIT_CARD", "IP_ADDRESS", "PHONE_NUMBER")

_PATTERNS = {
    # Loops over classes only: Java's matcher recurses for each round of a looped group.
    "EMAIL": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-][A-Za-z0-9.-]*(?<!\.)\.[A-Za-z]{2,}",
    "USA_SSN": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "IP_ADDRESS": _BEFORE + rf"{_OCTET}(?:\.{_OCTET}){{3}}" + _AFTER,
    "PHONE_NUMBER": r"(?=[0-9+(])(?<![0-9A-Za-z_+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    + _AFTER,
}

# A card has one of these numbers of digits, and passes the Luhn check.
_CARD_DIGITS = (16, 15, 14, 13)

# What any text holding the entity contains. It is quicker to look for than the
# entity itself, and most texts hold none.
_HINTS = {
    "USA_SSN": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "CREDIT_CARD": "[0-9](?:[ -]?[0-9]){12}",
    "IP_ADDRESS": r"[0-9]\.[0-9]{1,3}\.[0-9]",
    "PHONE_NUMBER": "[0-9]{3}[ .-][0-9]{4}",
}


def _hinted(text: Column, entity: str) -> Column:
    return text.contains("@") if entity == "EMAIL" else text.rlike(_HINTS[entity])


def _checked(entities: Sequence[str]) -> list[str]:
    unknown = [entity for entity in entities if entity not in ENTITIES]
    if unknown:
        raise JobError(f"mask_pii: unknown entities {unknown}, known are {list(ENTITIES)}")
    return [entity for entity in ENTITIES if entity in entities]


def _with_cards(text: Column, use: Callable[[Column], Column], otherwise: Column) -> Column:
    """``use`` of a pattern that fits the cards in ``text``, if there are any.

    A card may come right after other digits, so a number is looked for at
    every place one can start, each length by itself. Those that pass the Luhn
    check make up the pattern, the longest first.
    """
    found = F.concat(
        *[
            F.regexp_extract_all(text, F.lit(f"(?=({_BEFORE}[0-9](?:[ -]?[0-9]){{{n - 1}}}{_AFTER}))"), F.lit(1))
            for n in _CARD_DIGITS
        ]
    )
    cards = F.filter(F.array_distinct(found), lambda one: F.call_function("luhn_check", F.translate(one, " -", "")))

    def used(listed: Column) -> Column:
        pattern = F.concat(F.lit(f"{_BEFORE}(?:"), F.array_join(listed, "|"), F.lit(f"){_AFTER}"))
        return F.when(F.size(listed) > 0, use(pattern)).otherwise(otherwise)

    # An array of one, so that the cards are looked for once.
    return F.transform(F.array(cards), used)[0]


def _mask(text: Column, entity: str) -> Column:
    def masked(pattern: Column) -> Column:
        return F.regexp_replace(text, pattern, F.lit(MASK))

    if entity == "CREDIT_CARD":
        result = _with_cards(text, masked, text)
    else:
        result = masked(F.lit(_PATTERNS[entity]))
    return F.when(_hinted(text, entity), result).otherwise(text)


def _count(text: Column, entity: str) -> Column:
    def counted(pattern: Column) -> Column:
        return F.size(F.regexp_extract_all(text, pattern, F.lit(0)))

    if entity == "CREDIT_CARD":
        result = _with_cards(text, counted, F.lit(0))
    else:
        result = counted(F.lit(_PATTERNS[entity]))
    return F.when(_hinted(text, entity), result).otherwise(F.lit(0))


def _has_text(dt: DataType) -> bool:
    match dt:
        case StringType() | CharType() | VarcharType():
            return True
        case StructType():
            return any(_has_text(field.dataType) for field in dt.fields)
        case ArrayType():
            return _has_text(dt.elementType)
        case MapType():
            return _has_text(dt.valueType)
    return False


def _rewritten(value: Column, dt: DataType, change: Callable[[Column], Column]) -> Column:
    """``value`` with ``change`` applied to every text in it."""
    if not _has_text(dt):
        return value
    match dt:
        case StructType():
            parts = [
                _rewritten(value.getField(field.name), field.dataType, change).alias(field.name) for field in dt.fields
            ]
            return F.when(value.isNotNull(), F.struct(*parts))
        case ArrayType():
            return F.transform(value, lambda x: _rewritten(x, dt.elementType, change))
        case MapType():
            return F.transform_values(value, lambda _, v: _rewritten(v, dt.valueType, change))
    return change(value)


def redact(df: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Replace each match in any text by ``****``; the rest of the text stays.

    Keys of maps are left alone: masking could make two of them equal.
    """
    fields = df.schema.fields
    # One projection per entity, so that each works on the finished text of the
    # one before instead of repeating it.
    for entity in _checked(entities):
        df = df.select(
            *[
                _rewritten(column(field.name), field.dataType, lambda text: _mask(text, entity)).alias(field.name)
                if _has_text(field.dataType)
                else column(field.name)
                for field in fields
            ]
        )
    return df


def _leaves(value: Column, dt: DataType, path: str) -> list[tuple[str, Column, bool]]:
    """Path and value of every text leaf, and whether that is an array of texts."""
    if not _has_text(dt):
        return []
    match dt:
        case StructType():
            return [
                leaf
                for field in dt.fields
                for leaf in _leaves(value.getField(field.name), field.dataType, f"{path}.{field.name}")
            ]
        case ArrayType():
            return _element_leaves(value, dt.elementType, f"{path}[]")
        case MapType():
            return _element_leaves(F.map_values(value), dt.valueType, f"{path}{{}}")
    return [(path, value, False)]


def _element_leaves(values: Column, dt: DataType, path: str) -> list[tuple[str, Column, bool]]:
    """The leaves of an array's elements, each gathered over the elements."""

    def gathered(at: int) -> Column:
        def of(element: Column) -> Column:
            _, leaf, several = _leaves(element, dt, path)[at]
            return F.coalesce(leaf, F.array().cast("array<string>")) if several else F.array(leaf)

        return F.flatten(F.transform(values, of))

    if isinstance(dt, StringType):
        return [(path, values, True)]
    return [(name, gathered(at), True) for at, (name, _, _) in enumerate(_leaves(F.lit(None).cast(dt), dt, path))]


def _counts(df: DataFrame, entities: Sequence[str]) -> list[tuple[str, str, Column]]:
    """Path of a text, entity, and the number of its matches in a row.

    Every entity is looked for in the text as it is, so a place that looks like
    two of them counts for both.
    """
    wanted = _checked(entities)
    return [
        (path, entity, _total(leaf, several, entity))
        for field in df.schema.fields
        for path, leaf, several in _leaves(column(field.name), field.dataType, field.name)
        for entity in wanted
    ]


def _total(leaf: Column, several: bool, entity: str) -> Column:
    def add(total: Column, text: Column) -> Column:
        return total + F.coalesce(_count(text, entity), F.lit(0))

    return F.coalesce(F.aggregate(leaf, F.lit(0), add) if several else _count(leaf, entity), F.lit(0))


def detect(df: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Add ``DetectedEntities``: where which entity was found how often."""
    kind = "array<struct<column:string,entity:string,n:int>>"
    entries = [
        F.struct(F.lit(path).alias("column"), F.lit(entity).alias("entity"), number.alias("n"))
        for path, entity, number in _counts(df, entities)
    ]
    found = F.filter(F.array(*entries), lambda entry: entry["n"] > 0) if entries else F.array()
    return df.withColumn(DETECTED, found.cast(kind))


def report(df: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Rows and matches per entity and column, from one pass over ``df``.

    Every task counts for itself; one row per task is shuffled.
    """
    counts = _counts(df, entities)
    if not counts:
        return df.sparkSession.createDataFrame([], "entity string, column string, rows bigint, matches bigint")
    numbered = df.select(*[number.alias(f"n{at}") for at, (_, _, number) in enumerate(counts)])
    totals = numbered.agg(
        F.array(
            *[
                F.struct(
                    F.lit(entity).alias("entity"),
                    F.lit(path).alias("column"),
                    F.count_if(F.col(f"n{at}") > 0).alias("rows"),
                    F.coalesce(F.sum(F.col(f"n{at}")), F.lit(0)).cast("bigint").alias("matches"),
                )
                for at, (path, entity, _) in enumerate(counts)
            ]
        ).alias("totals")
    )
    return totals.select(F.inline("totals"))
