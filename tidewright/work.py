"""Settings for a while, and the folder that every executor can reach."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else one in the warehouse.

    Either is shared by all executors; a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_CHANGING = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session's settings changed for a while, then as they were.

    Threads take turns, so that none sees a setting taken back by another.
    """
    with _CHANGING:
        before = {key: spark.conf.get(key, None) for key in values}
        try:
            for key, value in values.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def rename_once(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder in one step; False, and nothing changes, if ``to`` exists already."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(to)
    context = hadoop.FileContext.getFileContext(
        old.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(old, new, options)
    except Exception:
        if context.util().exists(new):
            return False
        raise
    return True


def is_repeatable(df: DataFrame) -> bool:
    """Whether ``df`` gives the same rows each time it is read, as far as its expressions go."""
    return df._jdf.queryExecution().analyzed().deterministic()


def comes_in_order(df: DataFrame) -> bool:
    """Whether tasks that make ``df`` give their rows in the same order if run again: none comes out of a shuffle."""
    return not re.search(r"(?<!Broadcast)Exchange", df._jdf.queryExecution().executedPlan().toString())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` is under its limit for broadcasts."""
    plan = df._jdf.queryExecution().optimizedPlan()
    limit = df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(plan.stats().sizeInBytes()) <= limit


# Types every reader and writer of Parquet agrees on.
_STORABLE = (
    T.NumericType,
    T.StringType,
    T.CharType,
    T.VarcharType,
    T.BinaryType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _is_storable(dt: T.DataType) -> bool:
    match dt:
        case T.StructType():
            return bool(dt.fields) and all(_is_storable(field.dataType) for field in dt.fields)
        case T.ArrayType():
            return _is_storable(dt.elementType)
        case T.MapType():
            return _is_storable(dt.keyType) and _is_storable(dt.valueType)
    return isinstance(dt, _STORABLE)


_DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that it survives the loss of executors.

    The rows go into a table in the shared folder, of which later steps read
    only the columns they use; rows a table cannot hold are checkpointed. The table stays
    until it is discarded.
    """
    spark = df.sparkSession
    names = [name.lower() for name in df.columns]
    if _is_storable(df.schema) and len(set(names)) == len(names):
        folder = new_folder(spark, "staged")
        # What was shuffled on the way is in nobody's use once the table is written.
        with settings(spark, _DROP_SHUFFLES):
            df.write.option("compression", "zstd").parquet(folder)
        staged = spark.read.schema(df.schema).parquet(folder)
        staged._staged_in = folder
        return staged
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def discard(*staged: DataFrame) -> None:
    """Delete the tables of staged frames, whose last reader has been staged itself.

    Only then: a frame that is still lazy, or a task that is run again after an executor is lost, reads them anew.
    """
    for df in staged:
        folder = getattr(df, "_staged_in", None)
        if folder is not None:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
