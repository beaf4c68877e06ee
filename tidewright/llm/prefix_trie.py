"""A trie of conversation prefixes: double arrays by shard, shared upper nodes merged.

A conversation becomes a path, the 16-byte digests of its turns one after the other
(``paths``), so that the byte order of paths is the order of prefixes. Equal paths are one row
from then on. Paths are dealt into shards by ranges of that order: a shard is a run of
neighbouring prefixes, a hot first turn is simply many shards, and the only nodes that two
shards share lie on the common beginning of the last path of one and the first of the next.
Each shard packs its paths into BASE and CHECK arrays over its own dense turn numbers
(``DoubleArray``) and walks them (``shard_nodes``). Nodes that are not shared are whole there, with all
below them; the shared ones come in parts, which ``prefix_nodes`` adds up over all shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewright.names import column
from tidewright.work import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of a turn's digest in a path.
STEP = 16
#: Turns, counted once for equal conversations, that one shard is meant to hold.
SHARD_TURNS = 100_000
#: Nodes of a frame that a task hands back at once.
_NODES_OUT = 50_000


def conversations(
    df: DataFrame, *, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """``conv_id`` and ``turns``, an array of structs with ``digest`` and ``words``, in order.

    Only the digest and the number of words of a text are shuffled. The order is by turn, null first,
    then role and digest, so that it is the same in every run. A null role or text is empty. Rows with a
    null identifier belong to no conversation and are left out; repeated rows are repeated turns.
    """
    role, text = (F.coalesce(column(name).cast("string"), F.lit("")) for name in (role_column, text_column))
    # The length before the role keeps apart what would read the same when joined.
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(
        column(turn_column).alias("turn"),
        role.alias("role"),
        digest.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    known = df.where(column(id_column).isNotNull())
    ordered = F.sort_array(F.collect_list(turn))
    return known.groupBy(column(id_column).cast("long").alias("conv_id")).agg(
        F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns")
    )


def branched(convs: DataFrame, *, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of c - c % ``every``, then its own after its first h.

    h is the CRC-32 of c in decimal, modulo ``most``. Of a conversation that is absent nothing is taken,
    and what is shorter than h turns gives all it has; nothing may be left at all.
    """
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    own = convs.withColumns({"h": F.pmod(crc, F.lit(most)).cast("int"), "base_id": F.col("conv_id") - F.col("conv_id") % every})
    lent = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, most - 1).alias("first")
    )
    start = F.when(F.col("first").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("first", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(lent, "base_id", "left").select("conv_id", F.concat(start, rest).alias("turns"))


def paths(convs: DataFrame) -> DataFrame:
    """Add ``path``, the digests of all turns in one binary value, and keep ``words`` of each turn."""
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return convs.select(
        "conv_id", F.unhex(hexed).alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")
    )


def id_digests(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of the decimal ``conv_id`` ascending, joined by commas.

    Sorted identifiers of a hot node are joined into blocks by many tasks, ranges of
    (node, conv_id) each; then one task hashes a node's blocks in turn. Neither holds more than
    a block, as SHA-256 takes bytes in order and keeps a state of fixed size.
    """
    block = 4_096

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, first = None, [], None
        rows: list[tuple] = []
        for batch in batches:
            for own, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own != node or len(held) == block:
                    if held:
                        rows.append((node, first, ",".join(held)))
                    node, held, first = own, [], conv_id
                held.append(str(conv_id))
            if rows:
                yield _batch(rows, ("node", "first", "ids"), (pa.binary(), pa.int64(), pa.string()))
                rows = []
        if held:
            yield _batch([(node, first, ",".join(held))], ("node", "first", "ids"), (pa.binary(), pa.int64(), pa.string()))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        rows: list[tuple] = []
        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if own != node:
                    if state is not None:
                        rows.append((node, state.hexdigest()))
                    node, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield _batch(rows, ("node", "ends_sha256"), (pa.binary(), pa.string()))
                rows = []
        if state is not None:
            yield _batch([(node, state.hexdigest())], ("node", "ends_sha256"), (pa.binary(), pa.string()))

    ranged = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    blocks = ranged.mapInArrow(joined, "node binary, first long, ids string")
    return blocks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends_sha256 string")


def _batch(rows, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], list(names))


class DoubleArray:
    """BASE and CHECK of a trie: node s has a child by turn c if CHECK[BASE[s] + c] is s.

    Slot 0 is the root. ``codes`` are the dense turn numbers of sorted sequences, ``lengths`` how
    many of them each has. Slots are given out level by level: a node with several children takes
    the first base at which all of their places are free, one with a single child any free
    slot, which fills the holes that the others leave. A base may be negative.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        capacity = 64
        self.base = np.zeros(capacity, dtype=np.int64)
        self.check = np.full(capacity, -1, dtype=np.int64)
        self.check[0] = 0
        self.end = 1  # behind the last slot in use
        at = np.zeros(len(lengths), dtype=np.int64)
        alive = np.arange(len(lengths))
        depth = 0
        while True:
            alive = alive[lengths[alive] > depth]
            if not len(alive):
                break
            parents, steps = at[alive], codes[starts[alive] + depth]
            # Sequences are sorted, so that those with equal beginnings are neighbours.
            new = np.concatenate([[True], (parents[1:] != parents[:-1]) | (steps[1:] != steps[:-1])])
            self._add(parents[new], steps[new])
            at[alive] = self.base[parents] + steps
            depth += 1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _add(self, parents: np.ndarray, steps: np.ndarray) -> None:
        """Give slots to the children of one level; those of one parent are neighbours."""
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        many = np.diff(np.append(first, len(parents)))
        for i in np.flatnonzero(many > 1):
            own = np.sort(steps[first[i] : first[i] + many[i]])
            self._place_all(parents[first[i]], own - own[0], own)
        single = first[many == 1]
        free = np.flatnonzero(self.check < 0)
        if len(free) < len(single):
            self._room(len(self.check) + len(single))
            free = np.flatnonzero(self.check < 0)
        slots = free[: len(single)]
        self.base[parents[single]] = slots - steps[single]
        self.check[slots] = parents[single]
        self.end = max(self.end, int(slots.max(initial=0)) + 1)

    def _place_all(self, parent: int, offsets: np.ndarray, steps: np.ndarray) -> None:
        span = int(offsets[-1]) + 1
        # A few places among the free ones, then behind the last slot in use, where all are free.
        tried = np.flatnonzero(self.check < 0)[:16]
        for start in [*tried.tolist(), self.end]:
            self._room(start + span)
            if (self.check[start + offsets] < 0).all():
                break
        self.base[parent] = start - steps[0]
        self.check[start + offsets] = parent
        self.end = max(self.end, start + span)

    def step(self, nodes: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """The children of nodes by turns; -1 where there is none."""
        slots = self.base[nodes] + steps
        inside = (slots > 0) & (slots < len(self.check))
        found = np.where(inside, slots, 0)
        return np.where(inside & (self.check[found] == nodes), slots, -1)


@dataclass
class _Shard:
    """The distinct paths of one shard in order, as arrays."""

    paths: list[bytes]
    digests: np.ndarray
    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def _read_shard(rows: list[bytes]) -> _Shard:
    lengths = np.array([len(path) // STEP for path in rows], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    digests = np.frombuffer(b"".join(rows), dtype=f"V{STEP}")
    # Numbers by first appearance, level by level, so that children of one node lie close together.
    depth = np.arange(len(digests)) - np.repeat(starts, lengths)
    order = np.argsort(depth, kind="stable")
    codes = np.empty(len(digests), dtype=np.int64)
    if len(digests):
        keys = digests.view(np.uint64).reshape(-1, 2)[order]
        frame = pd.DataFrame({"a": keys[:, 0], "b": keys[:, 1]})
        codes[order] = frame.groupby(["a", "b"], sort=False).ngroup().to_numpy() + 1
    return _Shard(rows, digests, codes, starts, lengths)


def _common(a: bytes | None, b: bytes) -> int:
    """How many turns two paths begin with in common."""
    if a is None:
        return 0
    n = min(len(a), len(b)) // STEP
    x, y = (np.frombuffer(p[: n * STEP], dtype=np.uint8).reshape(n, STEP) for p in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


_NODE = (
    "node binary, parent binary, above array<binary>, depth long, is_upper boolean, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, words long, ends_sha256 string, leaves long, saved long"
)


def shard_nodes(rows: pd.DataFrame, before: bytes | None, after: bytes | None) -> Iterator[pd.DataFrame]:
    """All nodes of a shard; of those shared with the shards ``before`` or ``after``, its part.

    ``before`` is the last path of the shard before, ``after`` the first of the one after. ``rows`` has
    ``path, words, n, least, ends_sha256`` for each distinct path. ``leaves`` and ``saved`` are sums
    over the nodes below and the node itself, without shared ones.
    """
    rows = rows.sort_values("path", ignore_index=True)
    shard = _read_shard([bytes(path) for path in rows["path"]])
    trie = DoubleArray(shard.codes, shard.starts, shard.lengths)
    size, far = len(trie.check), np.iinfo(np.int64).max
    n_convs, least = np.zeros(size, dtype=np.int64), np.full(size, far)
    words, depths, sample = (np.zeros(size, dtype=np.int64) for _ in range(3))
    counts, smallest = rows["n"].to_numpy(np.int64), rows["least"].to_numpy(np.int64)
    all_words = np.concatenate([np.zeros(0, np.int64), *[np.asarray(w, dtype=np.int64) for w in rows["words"]]])
    first_shared = _common(before, shard.paths[0])
    last_shared = _common(after, shard.paths[-1])
    upper = np.zeros(size, dtype=bool)
    upper[0] = True

    at, alive, depth = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows)), 0
    while len(alive):
        if depth:
            steps = shard.starts[alive] + depth - 1
            at[alive] = trie.step(at[alive], shard.codes[steps])
            words[at[alive]] = all_words[steps]
        here = at[alive]
        np.add.at(n_convs, here, counts[alive])
        np.minimum.at(least, here, smallest[alive])
        depths[here], sample[here] = depth, alive
        if depth <= first_shared and alive[0] == 0:
            upper[at[0]] = True
        if depth <= last_shared and alive[-1] == len(rows) - 1:
            upper[at[-1]] = True
        alive = alive[shard.lengths[alive] > depth]
        depth += 1

    nodes = np.flatnonzero(n_convs)
    parents = trie.check
    n_children = np.bincount(parents[nodes[nodes > 0]], minlength=size)
    lower = nodes[~upper[nodes]]
    leaves, saved = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    leaves[lower] = n_children[lower] == 0
    saved[lower] = (n_convs[lower] - 1) * words[lower]
    for level in range(int(depths.max(initial=0)), 0, -1):
        own = lower[depths[lower] == level]
        np.add.at(leaves, parents[own], leaves[own])
        np.add.at(saved, parents[own], saved[own])
    # Children that are shared may be children in other shards too; those are counted when all are merged.
    whole_children = np.bincount(parents[lower], minlength=size)
    ends = dict(zip(at.tolist(), rows["ends_sha256"]))

    def name(node: int) -> bytes:
        return shard.paths[sample[node]][: depths[node] * STEP]

    for begin in range(0, len(nodes), _NODES_OUT):
        part = nodes[begin : begin + _NODES_OUT]
        is_upper = upper[part]
        under = upper[parents[part]] & (part > 0)
        yield pd.DataFrame({
            "node": [node_key(name(s)) if u else None for s, u in zip(part, is_upper)],
            "parent": [node_key(name(parents[s])) if u else None for s, u in zip(part, under)],
            "above": [
                [node_key(name(s)[: d * STEP]) for d in range(depths[s] + 1)] if u else None for s, u in zip(part, is_upper)
            ],
            "depth": depths[part],
            "is_upper": is_upper,
            "conv_id": least[part],
            "parent_conv_id": pd.Series(least[parents[part]], dtype="Int64").mask(under | (part == 0)),
            "n_convs": n_convs[part],
            "n_children": np.where(is_upper, whole_children[part], n_children[part]),
            "words": words[part],
            "ends_sha256": [ends.get(s) for s in part.tolist()],
            "leaves": leaves[part],
            "saved": saved[part],
        })


def node_key(prefix: bytes) -> bytes:
    """What a node is called across shards: a digest of its path of fixed length."""
    return hashlib.md5(prefix).digest()


def prefix_nodes(convs: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row for each distinct sequence of first turns of ``convs`` (``conv_id``, ``turns``).

    Returns ``conv_id`` (the smallest member), ``depth`` (0: the root, which has no text),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, as
    the contract of the query defines them. Conversations without turns are members of the root.
    Equal conversations are one row before they are dealt out, so that a hot one costs no task
    more than a row; a hot beginning is split over shards. One conversation has to fit
    into a task. No conversations give no nodes, not even a root. Two turns count as equal if their MD5 is.
    """
    known = stage(paths(convs))
    keyed = known.withColumn("node", F.unhex(F.md5("path")))
    ends = id_digests(stage(keyed.select("node", "conv_id")))
    counted = keyed.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("words").alias("words")
    )
    distinct = stage(counted.join(ends, "node").drop("node"))
    turns = distinct.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-turns // shard_turns))
    ranged = distinct.repartitionByRange(shards, "path") if shards > 1 else distinct.coalesce(1)
    dealt = stage(ranged.withColumn("shard", F.spark_partition_id()))

    # The neighbours of a shard, by its number; ranges without rows are passed over.
    edges = stage(dealt.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high")))
    numbers = edges.select("shard").orderBy("shard")
    previous = edges.select((F.col("shard") + 1).alias("shard"), F.col("high").alias("before"))
    following = edges.select((F.col("shard") - 1).alias("shard"), F.col("low").alias("after"))
    # A shard beside an empty range takes all of its first or last path as shared, which is right too.
    bounds = numbers.join(previous, "shard", "left").join(following, "shard", "left").join(edges, "shard").select(
        "shard",
        F.when(F.col("shard") > 0, F.coalesce("before", "low")).alias("before"),
        F.when(F.col("shard") < shards - 1, F.coalesce("after", "high")).alias("after"),
    )

    def walk(rows: Iterator[pd.DataFrame] | pd.DataFrame, beside: pd.DataFrame) -> pd.DataFrame:
        before, after = (None if pd.isna(v) else bytes(v) for v in beside.iloc[0][["before", "after"]])
        return pd.concat(shard_nodes(rows, before, after), ignore_index=True)

    nodes = stage(dealt.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInPandas(walk, _NODE))

    upper = nodes.where("is_upper")
    merged = upper.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("above").alias("above"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.first("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
    )
    merged = stage(merged)
    shared_children = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    full = stage(
        merged.join(shared_children, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        .withColumn("leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words"))
        .drop("more")
    )
    sums = full.select(F.explode("above").alias("node"), "leaves", "saved").groupBy("node").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    names = full.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"))
    nothing = hashlib.sha256(b"").hexdigest()

    def result(parent_conv_id: Column, n_leaves: str, saved_tokens: str) -> list[Column]:
        return [
            F.col("conv_id"), F.col("depth"), parent_conv_id.alias("parent_conv_id"), F.col("n_convs"), F.col("n_children"),
            F.col(n_leaves).alias("n_leaves"), F.col(saved_tokens).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        ]

    shared = full.join(sums, "node").join(names, "parent", "left").select(*result(F.col("of_parent"), "n_leaves", "saved_tokens"))
    # Most nodes have their parent in the same shard; only those right below a shared one look it up.
    whole = nodes.where("not is_upper")
    inner = whole.where("parent is null").select(*result(F.col("parent_conv_id"), "leaves", "saved"))
    below = whole.where("parent is not null").join(names, "parent").select(*result(F.col("of_parent"), "leaves", "saved"))
    return shared.unionByName(inner).unionByName(below)
