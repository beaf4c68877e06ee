"""Reconciling the schema of a batch with that of a table, by field name.

Untyped (void) fields are dropped, never given an invented type. The table's
order and scalar types win, new fields are appended, at any depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NullType, StructField, StructType

from tidewright.errors import SchemaMismatch
from tidewright.names import column, fold, is_case_sensitive


def _rebuilt(
    dt: DataType,
    leaf: Callable[[DataType], DataType | None],
    name: Callable[[str], str] = str,
    keep_empty: bool = True,
) -> DataType | None:
    """``dt`` made anew from its leaves up, every part nullable.

    What ``leaf`` turns into None is left out, and with it any array or map of
    it, and any struct that has no field then unless ``keep_empty``.
    """

    def again(part: DataType) -> DataType | None:
        return _rebuilt(part, leaf, name, keep_empty)

    if isinstance(dt, StructType):
        parts = ((field.name, again(field.dataType)) for field in dt.fields)
        fields = [StructField(name(label), part, True) for label, part in parts if part is not None]
        return StructType(fields) if fields or keep_empty else None
    if isinstance(dt, ArrayType):
        element = again(dt.elementType)
        return None if element is None else ArrayType(element, True)
    if isinstance(dt, MapType):
        key, value = again(dt.keyType), again(dt.valueType)
        return None if key is None or value is None else MapType(key, value, True)
    return leaf(dt)


def _unless_void(dt: DataType) -> DataType | None:
    return None if isinstance(dt, NullType) else dt


def nullable(dt: DataType) -> DataType:
    """The type with every part allowed to be NULL."""
    return _rebuilt(dt, lambda leaf: leaf)


def void_free(dt: DataType) -> DataType | None:
    """The type without its void parts; None if nothing is left of it."""
    return _rebuilt(dt, _unless_void, keep_empty=False)


def void_free_schema(schema: StructType) -> StructType:
    """``schema`` without void parts; it may end up with no fields."""
    return void_free(schema) or StructType([])


def has_void(dt: DataType) -> bool:
    """Whether any part of the type is void or a struct without fields."""
    return void_free(dt) != nullable(dt)


def void_free_ddl(dt: DataType) -> str | None:
    """The void-free type as DDL text, names quoted.

    Unlike with ``void_free`` a struct that loses every field stays, as
    ``struct<>``.
    """
    quoted = _rebuilt(dt, _unless_void, lambda name: "`" + name.replace("`", "``") + "`")
    return None if quoted is None else quoted.simpleString()


def kind(dt: DataType) -> str:
    """struct, array, map or scalar."""
    return {StructType: "struct", ArrayType: "array", MapType: "map"}.get(type(dt), "scalar")


def kind_mismatches(batch: DataType, live: DataType, case_sensitive: bool = False, path: str = "") -> list[str]:
    """Paths at which two types are of different kinds, at any depth."""
    if isinstance(batch, NullType):
        return []
    if kind(batch) != kind(live):
        return [f"{path or 'value'}: {kind(batch)} cannot become {kind(live)}"]
    match live:
        case StructType():
            fields = {fold(field.name, case_sensitive): field for field in live.fields}
            found = []
            for field in batch.fields:
                known = fields.get(fold(field.name, case_sensitive))
                if known is not None:
                    inner = f"{path}.{field.name}" if path else field.name
                    found += kind_mismatches(field.dataType, known.dataType, case_sensitive, inner)
            return found
        case ArrayType():
            return kind_mismatches(batch.elementType, live.elementType, case_sensitive, f"{path}[]")
        case MapType():
            return kind_mismatches(batch.keyType, live.keyType, case_sensitive, f"{path}{{key}}") + kind_mismatches(
                batch.valueType, live.valueType, case_sensitive, f"{path}{{value}}"
            )
    return []


def merge_schema(live: StructType, batch: StructType, case_sensitive: bool = False) -> StructType:
    """Fields of ``live`` in their order, then those only ``batch`` has."""
    arriving = {fold(field.name, case_sensitive): field for field in batch.fields}
    merged = []
    for field in live.fields:
        other = arriving.pop(fold(field.name, case_sensitive), None)
        dt = field.dataType if other is None else _merge_type(field.dataType, other.dataType, case_sensitive)
        merged.append(StructField(field.name, dt, True))
    return StructType(merged + [StructField(field.name, field.dataType, True) for field in arriving.values()])


def _merge_type(live: DataType, batch: DataType, case_sensitive: bool) -> DataType:
    if type(live) is not type(batch):
        return live
    match live:
        case StructType():
            return merge_schema(live, batch, case_sensitive)
        case ArrayType():
            return ArrayType(_merge_type(live.elementType, batch.elementType, case_sensitive), True)
        case MapType():
            return MapType(live.keyType, _merge_type(live.valueType, batch.valueType, case_sensitive), True)
    return live


def conform(df: DataFrame, target: StructType, strict: bool = False) -> DataFrame:
    """``df`` with exactly the fields of ``target``, in its order.

    Fields are matched by name at every depth; missing ones are NULL, others
    are left out. A column that already fits is passed on untouched, so
    filters still reach the scan. Types between which Spark has no cast are
    refused. A value that cannot be cast becomes NULL, or fails the job if ``strict``; as the key of a map it always fails it. A
    NULL struct stays NULL.
    """
    exact = is_case_sensitive(df)
    mismatches = kind_mismatches(df.schema, target, exact)
    if mismatches:
        raise SchemaMismatch("; ".join(mismatches))
    present = {fold(field.name, exact): field for field in df.schema.fields}
    columns = []
    for field in target.fields:
        source = present.get(fold(field.name, exact))
        if source is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            value = _conformed(column(source.name), source.dataType, field.dataType, exact, strict)
            columns.append(value.alias(field.name))
    try:
        return df.select(*columns)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("DATATYPE_MISMATCH.CAST"):
            raise
        raise SchemaMismatch(error.getMessage()) from error


def _conformed(value: Column, source: DataType, target: DataType, exact: bool, strict: bool) -> Column:
    if nullable(source) == nullable(target):
        return value
    if isinstance(source, NullType):
        return F.lit(None).cast(target)
    match target:
        case StructType():
            present = {fold(field.name, exact): field for field in source.fields}
            parts = []
            for field in target.fields:
                known = present.get(fold(field.name, exact))
                if known is None:
                    part = F.lit(None).cast(field.dataType)
                else:
                    part = _conformed(value.getField(known.name), known.dataType, field.dataType, exact, strict)
                parts.append(part.alias(field.name))
            return F.when(value.isNotNull(), F.struct(*parts))
        case ArrayType():
            return F.transform(
                value, lambda x: _conformed(x, source.elementType, target.elementType, exact, strict)
            )
        case MapType():
            if nullable(source.keyType) != nullable(target.keyType):
                value = F.transform_keys(
                    value, lambda k, _: _conformed(k, source.keyType, target.keyType, exact, strict)
                )
            if nullable(source.valueType) == nullable(target.valueType):
                return value
            return F.transform_values(
                value, lambda _, v: _conformed(v, source.valueType, target.valueType, exact, strict)
            )
    return value.cast(target) if strict else value.try_cast(target)
