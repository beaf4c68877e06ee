"""Which files a job has processed: committed manifests, and one that is being worked on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.errors import JobError
from tidewright.work import rename_once

SCHEMA = "source string, path string, length long, modified timestamp"

#: Manifests that are read one by one before they are put together into one table.
LOOSE_RUNS = 20


class Ledger:
    """A folder of manifests, tables of the files of all sources that made up one batch.

    ``pending`` is the batch that a run has begun: it is written aside and renamed into
    place before any of its files is read. ``done/run-<n>`` are batches whose results are
    written: ``pending`` renamed. Both renames are single steps that fail if the place is taken,
    so a run that dies leaves either no trace of its batch, or the whole of it for the next run to
    repeat. ``done/upto-<n>`` holds all manifests up to a run in one table.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, kind: str) -> list[int]:
        store, done = self._hadoop("done")
        if not store.exists(done):
            return []
        names = [status.getPath().getName() for status in store.listStatus(done)]
        return sorted(int(n.removeprefix(kind)) for n in names if n.startswith(kind) and n.removeprefix(kind).isdigit())

    def _read(self, *names: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.folder}/{name}" for name in names])

    def seen(self) -> DataFrame:
        """The files of all committed batches."""
        upto = self._numbers("upto-")[-1:]
        names = [f"done/upto-{n}" for n in upto] + [f"done/run-{n}" for n in self._numbers("run-") if not upto or n > upto[0]]
        return self._read(*names) if names else self.spark.createDataFrame([], SCHEMA)

    def pending(self) -> DataFrame | None:
        """The batch that some run began and did not commit."""
        store, path = self._hadoop("pending")
        return self._read("pending") if store.exists(path) else None

    def begin(self, files: DataFrame) -> DataFrame | None:
        """Make these files the pending batch; None if there are none."""
        aside = f"new-{uuid.uuid4().hex}"
        files.select("source", "path", "length", "modified").write.parquet(f"{self.folder}/{aside}")
        if self._read(aside).first() is None:
            store, path = self._hadoop(aside)
            store.delete(path, True)
            return None
        if not rename_once(self.spark, f"{self.folder}/{aside}", f"{self.folder}/pending"):
            raise JobError(f"bookmark: another run has begun a batch in '{self.folder}'")
        return self._read("pending")

    def commit(self) -> None:
        """The pending batch is done. Loose manifests are put together now and then."""
        upto = self._numbers("upto-")[-1:]
        runs = self._numbers("run-")
        number = max([0, *runs, *upto]) + 1
        store, done = self._hadoop("done")
        store.mkdirs(done)
        if not rename_once(self.spark, f"{self.folder}/pending", f"{self.folder}/done/run-{number}"):
            raise JobError(f"bookmark: another run has committed to '{self.folder}'")
        if len(runs) + 1 > LOOSE_RUNS:
            self._put_together(number)

    def _put_together(self, number: int) -> None:
        """Write all manifests as one; only then are the single ones deleted, which readers pass over anyway."""
        aside = f"new-{uuid.uuid4().hex}"
        old = [(kind, n) for kind in ("run-", "upto-") for n in self._numbers(kind)]
        # Sorted by path, so that a table of many names is small; no more tasks than that needs.
        self.seen().repartitionByRange(F.col("source"), F.col("path")).sortWithinPartitions("source", "path").write.parquet(
            f"{self.folder}/{aside}"
        )
        if rename_once(self.spark, f"{self.folder}/{aside}", f"{self.folder}/done/upto-{number}"):
            for kind, n in old:
                store, path = self._hadoop(f"done/{kind}{n}")
                store.delete(path, True)
