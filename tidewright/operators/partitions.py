"""Columns a sink is partitioned by, derived from a timestamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tidewright.errors import JobError
from tidewright.names import column, fold, is_case_sensitive

INGESTION_COLUMN = "ingestion_timestamp"

_UNITS = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def partition_columns(
    df: DataFrame,
    partition_by: Sequence[str],
    timestamp_column: str | None = None,
    create_timestamp: bool = False,
) -> DataFrame:
    """Add the missing ones of year, month and day.

    ``create_timestamp`` reads the clock into ``ingestion_timestamp`` and
    derives from that instead. Without ``partition_by`` nothing is added, not
    even the ingestion time. Text is parsed; text that is no timestamp gives
    NULL rather than failing the job.
    """
    unknown = [unit for unit in partition_by if unit not in _UNITS]
    if unknown:
        raise JobError(f"partition_by: {unknown} must be among {list(_UNITS)}")
    if not partition_by:
        return df
    if create_timestamp:
        df = df.withColumn(INGESTION_COLUMN, F.current_timestamp())
        moment = column(INGESTION_COLUMN)
    else:
        moment = _timestamp(df, timestamp_column or "event_time", partition_by)
    exact = is_case_sensitive(df)
    present = {fold(name, exact) for name in df.columns}
    missing = [unit for unit in partition_by if fold(unit, exact) not in present]
    return df.withColumns({unit: _UNITS[unit](moment) for unit in missing}) if missing else df


def _timestamp(df: DataFrame, name: str, partition_by: Sequence[str]) -> Column | None:
    exact = is_case_sensitive(df)
    fields = {fold(field.name, exact): field for field in df.schema.fields}
    field = fields.get(fold(name, exact))
    if field is None:
        if all(fold(unit, exact) in fields for unit in partition_by):
            return None
        raise JobError(f"partition_by: timestamp column '{name}' is not among {df.columns}")
    moment = column(field.name)
    return F.try_to_timestamp(moment) if isinstance(field.dataType, StringType) else moment
