"""Row filter and projections. All stay inside one code-generated stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewright.names import Expression, column, expression, fold, is_case_sensitive


def filter_rows(df: DataFrame, condition: Expression | None = None) -> DataFrame:
    """Keep the rows for which ``condition`` is true; none keeps every row."""
    if condition is None or condition is True:
        return df
    return df.filter(expression(df, condition))


def select(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns in the given order; ``a.b`` reaches into a struct."""
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remove columns; names that do not exist are ignored."""
    return df.drop(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, so that two names can be swapped."""
    if not mapping:
        return df
    exact = is_case_sensitive(df)
    wanted = {fold(old, exact): new for old, new in mapping.items()}
    return df.select(*[column(name).alias(wanted.get(fold(name, exact), name)) for name in df.columns])


def add_column(df: DataFrame, name: str, value: Expression | None = None) -> DataFrame:
    """Append a column or replace the one of that name; no value gives NULL."""
    return df.withColumn(name.strip(), F.lit(None) if value is None else expression(df, value))
