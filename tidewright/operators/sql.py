"""SQL over the frames of a job."""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_views = threading.RLock()


def sql(spark: SparkSession, frames: Mapping[str, DataFrame], query: str = "SELECT * FROM source") -> DataFrame:
    """Run ``query`` with each frame visible as a view of its name.

    Analysis resolves the views at once, so they are taken away again (and any
    view they hid is put back) before the lazy result is returned.
    """
    with _views:
        hidden: dict[str, DataFrame] = {}
        for name in frames:
            if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
                hidden[name] = spark.table(name)
        try:
            for name, frame in frames.items():
                frame.createOrReplaceTempView(name)
            return spark.sql(query.strip())
        finally:
            for name in frames:
                if name in hidden:
                    hidden[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)
