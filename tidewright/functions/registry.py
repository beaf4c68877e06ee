"""Making user functions visible to the SQL text of a job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.udtf import UserDefinedTableFunction


def register(spark: SparkSession, functions: Mapping[str, object]) -> None:
    """Register scalar, vectorised, aggregating and table functions by name.

    Each value is what ``udf``, ``pandas_udf`` or ``udtf`` returns; a plain
    callable is taken as a function of strings.
    """
    for name, function in functions.items():
        if isinstance(function, UserDefinedTableFunction):
            spark.udtf.register(name, function)
        else:
            spark.udf.register(name, function)
