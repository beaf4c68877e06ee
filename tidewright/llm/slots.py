"""Shards by fixed virtual slots and a versioned map from slots to shards.

Every row is hashed into one of a few thousand slots (``slot_number``), which never changes.
Bytes and rows are summed by slot (``slot_totals``), so that what decides the shards has a
row a slot, however large the table. A map says which shard a slot belongs to; it is stored
(``SlotMaps``), and each rebalancing (``rebalanced``, ``grown``) is an edit that moves
some slots and is stored as the next version. Rows find their shard by looking their slot up.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidewright.names import column
from tidewright.work import rename_once, stage

#: Slots of a map. All that reaches the driver, or is broadcast, has at most one row a slot.
SLOTS = 4_096

_MAP_SCHEMA = "version int, slot int, shard int, bytes long, rows long"


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none), and eight for the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of a text in UTF-8; of a null text that of no bytes, 0."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def slot_number(values: Sequence[Column], slots: int = SLOTS) -> Column:
    """The slot of a row, by the values as text; the same in every run and on every cluster."""
    known = [F.coalesce(value.cast("string"), F.lit("")) for value in values]
    return F.pmod(F.xxhash64(*known), F.lit(slots)).cast("int")


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """Bytes and rows of each slot, from ``virtual_slot`` and ``size``: an array of ``slots`` by 2."""
    totals = np.zeros((slots, 2), dtype=np.int64)
    summed = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    for slot, size, count in summed.collect():
        totals[slot] = size, count
    return totals


@dataclass(frozen=True)
class SlotMap:
    """One version: the shard of each slot, with the bytes and rows it was decided from."""

    version: int
    shards: int
    shard_of: np.ndarray
    totals: np.ndarray

    @property
    def shard_bytes(self) -> np.ndarray:
        return np.bincount(self.shard_of, weights=self.totals[:, 0], minlength=self.shards).astype(np.int64)


def first_map(shards: int, totals: np.ndarray) -> SlotMap:
    """Version 1: the slots dealt in turn, whatever they hold."""
    return SlotMap(1, shards, np.arange(len(totals)) % shards, totals)


def _best_move(from_bytes: np.ndarray, to_bytes: np.ndarray, gap: int) -> tuple[int, int | None] | None:
    """Of two shards' slots, the one to hand over, or the two to exchange, that best halve ``gap``.

    Positions in the two lists; None where no move makes the gap smaller.
    """
    best, chosen = gap, None
    for i in np.flatnonzero((from_bytes > 0) & (from_bytes < gap)):
        left = abs(gap - 2 * int(from_bytes[i]))
        if left < best:
            best, chosen = left, (int(i), None)
    if len(to_bytes):
        order = np.argsort(to_bytes, kind="stable")
        ordered = to_bytes[order]
        # For each slot given, the slot taken back whose difference comes nearest half the gap.
        at = np.searchsorted(ordered, from_bytes - gap // 2)
        for near in (np.clip(at - 1, 0, len(ordered) - 1), np.clip(at, 0, len(ordered) - 1)):
            left = np.abs(gap - 2 * (from_bytes - ordered[near]))
            i = int(np.argmin(left))
            if left[i] < best:
                best, chosen = int(left[i]), (i, int(order[near[i]]))
    return chosen


def rebalanced(old: SlotMap, totals: np.ndarray | None = None, tolerance: float = 0.0005) -> SlotMap:
    """The next version: slots moved from the fullest to the emptiest shard until their bytes are near.

    It ends when the two differ by at most ``tolerance`` of the mean. A shard that no slot or
    exchange of two brings nearer to the emptiest is passed over, until another move is made.
    Each move lowers the sum of squared bytes, so that it does end. Ties go to
    the lower shard and slot. What is not moved stays where it was.
    """
    totals = old.totals if totals is None else totals
    shard_of, sizes = old.shard_of.copy(), totals[:, 0]
    load = np.bincount(shard_of, weights=sizes, minlength=old.shards).astype(np.int64)
    passed = np.zeros(old.shards, dtype=bool)
    while True:
        full, empty = int(np.argmax(np.where(passed, -1, load))), int(np.argmin(load))
        gap = int(load[full] - load[empty])
        if passed[full] or gap <= tolerance * load.mean():
            break
        given, taken = np.flatnonzero(shard_of == full), np.flatnonzero(shard_of == empty)
        move = _best_move(sizes[given], sizes[taken], gap)
        if move is None:
            passed[full] = True
            continue
        passed[:] = False
        shard_of[given[move[0]]] = empty
        moved = int(sizes[given[move[0]]])
        if move[1] is not None:
            shard_of[taken[move[1]]] = full
            moved -= int(sizes[taken[move[1]]])
        load[full] -= moved
        load[empty] += moved
    return replace(old, version=old.version + 1, shard_of=shard_of, totals=totals)


def grown(old: SlotMap, totals: np.ndarray | None = None) -> SlotMap:
    """The next version with one more shard, which takes slots from the others until it has its share.

    Slots move into the new shard only: each time the largest one of the fullest shard
    that still fits into the share, so that few of them move.
    """
    totals = old.totals if totals is None else totals
    shard_of, sizes, new = old.shard_of.copy(), totals[:, 0], old.shards
    load = np.bincount(shard_of, weights=sizes, minlength=new + 1).astype(np.int64)
    share = int(load.sum()) // (new + 1)
    closed = np.zeros(new, dtype=bool)
    while not closed.all():
        full = int(np.argmax(np.where(closed, -1, load[:new])))
        own = np.flatnonzero((shard_of == full) & (sizes > 0) & (sizes <= share - load[new]))
        # A shard isn't brought below the share by more than half a slot.
        own = own[load[full] - sizes[own] // 2 >= share]
        if not len(own):
            closed[full] = True
            continue
        slot = own[np.argmax(sizes[own])]
        shard_of[slot] = new
        load[full] -= sizes[slot]
        load[new] += sizes[slot]
    return SlotMap(old.version + 1, new + 1, shard_of, totals)


class SlotMaps:
    """The versions of a map, each a small Parquet table ``v<number>`` of a shared folder.

    A version is written beside its place and then renamed into it in one step that fails if
    the place is taken. Of two writers of a version one is refused; a reader never
    sees half of one, and old versions stay readable.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        top = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        store = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not store.exists(top):
            return []
        names = [status.getPath().getName() for status in store.listStatus(top)]
        return sorted(int(name[1:]) for name in names if name[:1] == "v" and name[1:].isdigit())

    def save(self, new: SlotMap) -> SlotMap:
        rows = [
            (new.version, slot, int(shard), int(size), int(count))
            for slot, (shard, (size, count)) in enumerate(zip(new.shard_of, new.totals))
        ]
        beside = f"_new-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, _MAP_SCHEMA).coalesce(1).write.parquet(f"{self.folder}/{beside}")
        if not rename_once(self.spark, f"{self.folder}/{beside}", f"{self.folder}/v{new.version}"):
            raise PySparkException(f"version {new.version} of {self.folder} exists already")
        return new

    def frame(self, version: int | None = None) -> DataFrame:
        """``version, slot, shard, bytes, rows`` of a version, the latest by default."""
        known = self.versions()
        wanted = known[-1] if version is None and known else version
        if wanted not in known:
            raise PySparkException(f"{self.folder} has no version {wanted}")
        return self.spark.read.schema(_MAP_SCHEMA).parquet(f"{self.folder}/v{wanted}")

    def load(self, version: int | None = None) -> SlotMap:
        rows = sorted(self.frame(version).collect(), key=lambda row: row["slot"])
        shard_of = np.array([row["shard"] for row in rows], dtype=np.int64)
        totals = np.array([(row["bytes"], row["rows"]) for row in rows], dtype=np.int64)
        return SlotMap(rows[0]["version"], int(shard_of.max()) + 1, shard_of, totals)


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add ``shard`` to rows that have ``virtual_slot``. The map has a row a slot, so it is broadcast."""
    looked_up = F.broadcast(slot_map.select(F.col("slot").alias("_slot"), "shard"))
    return rows.join(looked_up, F.col("virtual_slot") == F.col("_slot")).drop("_slot")


def write_shards(
    df: DataFrame, maps: SlotMaps, folder: str, *, by: Sequence[str] = ("doc_id",), slots: int = SLOTS
) -> None:
    """Write rows into ``shard=<n>`` folders by the latest map; large shards become several files.

    ``df`` may not have columns ``virtual_slot`` or ``shard``.
    """
    rows = df.withColumn("virtual_slot", slot_number([column(name) for name in by], slots))
    assign(rows, maps.frame()).drop("virtual_slot").hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def shard_documents(
    df: DataFrame,
    folder: str,
    *,
    shards: int = 24,
    slots: int = SLOTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Deal rows into ``shards`` of nearly equal bytes; ``folder`` receives the map's versions 1 and 2.

    Returns a row for each row: the identifier, ``size``, ``text_crc32``, ``virtual_slot``,
    ``shard`` and ``place``, which numbers the rows of a shard from 0 without gaps in the order of
    slots, identifiers, CRCs and sizes. Version 1 deals the slots in turn; version 2 edits it by the
    bytes found. Sizes differ by no more than whole slots can even out: with fewer rows
    than slots, or one row larger than a shard's share, that is a row.

    The slot is hashed from identifier, CRC and size, so that rows without an identifier, or with
    the same one, are spread unless they are equal in all three. Equal rows are counted
    before the shuffle and stay one row until they are numbered. A null text has no bytes, a null
    identifier stays null; other columns don't matter, whatever their names. An empty table
    gives no rows and two maps. The text is read once; what follows is staged.
    """
    slim = df.select(
        column(id_column).alias("id"),
        text_size(column(text_column)).alias("size"),
        text_crc32(column(text_column)).alias("text_crc32"),
    )
    slot = slot_number([F.col("id"), F.col("text_crc32"), F.col("size")], slots)
    rows = stage(slim.withColumn("virtual_slot", slot))
    maps = SlotMaps(df.sparkSession, folder)
    first = maps.save(first_map(shards, slot_totals(rows, slots)))
    maps.save(rebalanced(first))

    latest = maps.frame()
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = latest.select(
        F.col("slot").alias("_slot"), "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    counted = rows.groupBy("virtual_slot", "id", "text_crc32", "size").agg(F.count(F.lit(1)).alias("copies"))
    within = Window.partitionBy("virtual_slot").orderBy("id", "text_crc32", "size")
    earlier = F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(
        F.broadcast(starts), F.col("virtual_slot") == F.col("_slot")
    )
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        "virtual_slot",
        "shard",
        (F.col("start") + F.col("earlier") + F.col("copy")).alias("place"),
    )
