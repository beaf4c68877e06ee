"""Files below a path as a table, listed by tasks."""

from __future__ import annotations

import posixpath
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.work import stage

# The listing code travels with the job, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENTRY = "path string, is_folder boolean, length long, modified timestamp"
_FIELDS = pa.schema([
    ("path", pa.string()), ("is_folder", pa.bool_()), ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")),
])
_ROWS_OUT = 10_000
_PATTERN = re.compile(r"[\\{}\[\]*?]")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modified`` of every file at or below ``path``, which may be a glob.

    Hidden files and folders are left out, as Spark's readers do. Folders are listed by tasks, one
    level after the other, and what they find is staged; a task holds the entries of one folder. On stores
    that tasks cannot open without Spark, its own listing on the driver is used instead.
    """
    root = _qualified(spark, path)
    base, wanted = _split_glob(root)
    if not _tasks_can_open(base):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        return listed.select("path", "length", F.col("modificationTime").alias("modified"))
    tasks = spark.sparkContext.defaultParallelism
    found, folders = None, spark.createDataFrame([(base,)], "path string")
    while True:
        level = stage(folders.mapInArrow(_list, _ENTRY))
        own = level.where("not is_folder").select("path", "length", "modified")
        found = own if found is None else found.unionByName(own)
        folders = level.where("is_folder").select("path")
        if folders.first() is None:
            break
        # A folder each task, however few or many there are.
        folders = folders.repartition(tasks)
    return found.where(F.col("path").rlike(wanted)) if wanted else found


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority, as Spark's readers take it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(hadoop).toString()


def _split_glob(path: str) -> tuple[str, str | None]:
    """The folder above all patterns, and a regular expression of the paths a glob takes."""
    if not _PATTERN.search(path):
        return path, None
    plain = path[: _PATTERN.search(path).start()]
    base = plain[: plain.rindex("/")] or "/"
    out, depth, at = [], 0, 0
    while at < len(path):
        char = path[at]
        if char == "\\" and at + 1 < len(path):
            at += 1
            out.append(re.escape(path[at]))
        elif char == "*":
            out.append("[^/]*")
        elif char == "?":
            out.append("[^/]")
        elif char == "[" and "]" in path[at + 1 :]:
            end = path.index("]", at + 1)
            inside = path[at + 1 : end]
            out.append(f"[^{inside[1:]}]" if inside[:1] in "!^" else f"[{inside}]")
            at = end
        elif char == "{":
            depth += 1
            out.append("(?:")
        elif char == "}" and depth:
            depth -= 1
            out.append(")")
        elif char == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(char))
        at += 1
    return base, "^" + "".join(out) + "(/.*)?$"


def _store(path: str) -> tuple[pa.fs.FileSystem, str, str]:
    """The store of a qualified path, the path in it, and what comes before that path."""
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        plain = "/" + rest.lstrip("/")
        return pa.fs.LocalFileSystem(), plain, "file:"
    authority, inside = re.match(r"//([^/]*)(.*)", rest).groups()
    store, top = pa.fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    top = top.rstrip("/")
    return store, top + inside, f"{scheme}://{authority}" if not top else f"{scheme}://{authority}".removesuffix(top)


def _tasks_can_open(path: str) -> bool:
    try:
        store, inside, _ = _store(path)
        return store.get_file_info(inside).type != pa.fs.FileType.NotFound
    except (pa.ArrowException, OSError, AttributeError):
        return False


def _is_hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, inside, before = _store(path)
            at = store.get_file_info(inside)
            if at.type == pa.fs.FileType.File:
                entries = [at]
            else:
                entries = store.get_file_info(pa.fs.FileSelector(inside, allow_not_found=True))
            rows = [
                {"path": before + e.path, "is_folder": e.type == pa.fs.FileType.Directory, "length": e.size, "modified": e.mtime}
                for e in entries
                if e is at or not _is_hidden(posixpath.basename(e.path))
            ]
            for start in range(0, len(rows), _ROWS_OUT):
                yield pa.RecordBatch.from_pylist(rows[start : start + _ROWS_OUT], _FIELDS)
