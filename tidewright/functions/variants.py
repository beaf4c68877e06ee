"""JSON text whose fields are not known beforehand, through VARIANT."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType, StringType

from tidewright.functions.schema import kind_mismatches, merge_schema, void_free
from tidewright.names import column


def json_type(df: DataFrame, name: str) -> DataType:
    """The type that all JSON values of a text column have in common; string where they have none.

    Each value is parsed once, as a variant; types are merged in the tasks before they are put together. Text that is not
    JSON counts as null. Parts that are always null are left out, and parts of different kinds are strings.
    """
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(column(name))).alias("t")).first()["t"]
    return _type_of(found) or StringType()


def _type_of(text: str | None) -> DataType | None:
    if text is None:
        return None
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", text)
    # What a variant is not made more of: values of different kinds.
    ddl = re.sub(r"\bVARIANT\b", "STRING", ddl)
    return void_free(_parsed(ddl))


def _parsed(ddl: str) -> DataType:
    return StructType.fromDDL(f"v {ddl}")["v"].dataType


def typed(df: DataFrame, name: str, known: DataType | None = None) -> DataFrame:
    """``df`` with the JSON text of a column as typed parts, by ``json_type``.

    ``known`` is the type of earlier batches: its parts keep their types, new parts come after them, so that the result
    can be written to a table that evolves. A value that does not fit, or is not JSON, is null.
    """
    kind = json_type(df, name)
    if isinstance(known, StructType):
        merged = merge_schema(StructType([StructField("v", known)]), StructType([StructField("v", kind)]))
        fits = not kind_mismatches(kind, known) if isinstance(kind, StructType) else False
        kind = merged["v"].dataType if fits else known
    elif known is not None:
        kind = known
    value = F.try_variant_get(F.try_parse_json(column(name)), "$", kind.simpleString())
    return df.withColumn(name, value)
