"""Files in any format Spark reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewright.names import require


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
    columns: Sequence[str] = (),
    schema: StructType | str | None = None,
) -> DataFrame:
    """One path or several. A ``paths`` option takes the place of ``path``.

    ``columns`` narrows the scan. Reading is lazy, so filters and projections
    of later steps reach the files as well. Give a ``schema`` for text formats:
    to infer one, Spark reads all of the files first.
    """
    settings = dict(options or {})
    paths = settings.pop("paths", None) or path
    require(paths, "file source", "path")
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(format).options(**settings)
    df = (reader.schema(schema) if schema is not None else reader).load(paths)
    return df.select(*columns) if columns else df
