"""Column references by exact name."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidewright.errors import JobError

Expression = str | Column | Callable[[DataFrame], Column]


def column(name: str) -> Column:
    """The column called ``name``, even if the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def expression(df: DataFrame, value: Expression) -> Column:
    """SQL text, a Column, or a function of the frame returning a Column."""
    if isinstance(value, Column):
        return value
    if callable(value):
        return value(df)
    return F.expr(value.strip())


def fold(name: str, case_sensitive: bool) -> str:
    return name if case_sensitive else name.lower()


def is_case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"


def has_unique_names(df: DataFrame) -> bool:
    names = [name.lower() for name in df.columns]
    return len(set(names)) == len(names)


def require(value, what: str, field: str):
    if not value:
        raise JobError(f"{what}: '{field}' is required")
    return value


def unused(prefix: str, taken: Iterable[str]) -> str:
    """A column name starting with ``prefix`` that is not in ``taken``."""
    lowered = {name.lower() for name in taken}
    candidate, number = prefix, 0
    while candidate.lower() in lowered:
        number += 1
        candidate = f"{prefix}{number}"
    return candidate
