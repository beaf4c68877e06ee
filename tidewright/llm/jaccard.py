"""Documents with like shingle sets: a parity-sketch join, verified, and its components.

Every document's set of word shingles is XOR-hashed into a bit sketch: a bit is the
parity of the shingles that hash to it, so the Hamming distance of two sketches is
at most the size of the sets' symmetric difference. Sets that are alike enough
differ by at most a ninth of their sizes together (for 0.8), so of enough blocks of
the sketch one is equal. Per band of sizes the blocks are joined, pairs are
filtered by a second, dense sketch, and what is left is verified on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewright.llm.components import components
from tidewright.llm.shingles import mixed, shingle_hashes
from tidewright.names import column
from tidewright.work import discard, stage

_CHUNK = 4_096
_U = np.uint64


def _set_of(text: str, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _signature(own: np.ndarray) -> int:
    """Names a set; what has one name is taken as one set."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def most_apart(size: int, likeness: tuple[int, int]) -> int:
    """The largest symmetric difference of a set of this size and any set that is like it.

    With the likeness p / q: the larger set has at most size * q / p members, and
    the difference is at most (q - p) / (q + p) of both sizes.
    """
    p, q = likeness
    return (size + size * q // p) * (q - p) // (q + p)


def block_keys(own: np.ndarray, band: int, likeness: tuple[int, int]) -> np.ndarray:
    """Keys of the first blocks that aren't zero, enough for one to be equal in any like set.

    Band b lays sketches out in blocks for sets of up to 2^(b+1) members, each block
    2^32 bits wide, known by the XOR of codes of its set bits. Two like sets differ in at most
    d = ``most_apart`` blocks. Both take their first d + 1 blocks that aren't zero: the
    first block of one that is equal in both is preceded, in either set, by at most d blocks that aren't
    zero, each of which differs. A set with fewer such blocks could differ in all of them; it
    then meets the others of that kind under a key of their own.
    """
    need = most_apart(len(own), likeness) + 1
    blocks = most_apart(2 << band, likeness) * 4 // 3 + 9
    place = ((own >> _U(32)) * _U(blocks)) >> _U(32)
    order = np.argsort(place, kind="stable")
    starts = np.flatnonzero(np.diff(place[order], prepend=_U(blocks)))
    parity = np.bitwise_xor.reduceat(mixed(own[order]), starts)
    used = parity != 0
    found, parity = place[order][starts][used][:need], parity[used][:need]
    keys = mixed(parity ^ mixed(found * _U(64) + _U(band)))
    return keys if len(keys) == need else np.append(keys, mixed(np.array([band + 1], _U)))


def dense_sketch(own: np.ndarray) -> bytes:
    """Parities at a power of two of bits, four for each member at least."""
    bits = max(64, 1 << (4 * len(own) - 1).bit_length()) if len(own) else 64
    parity = np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches at the width of the narrowest, a row each; halves of wider ones are XORed."""
    width = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), width), _U)
    for i, sketch in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, _U).reshape(-1, width), axis=0)
    return out


def _sets(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(column(text_column), F.lit(""))
    return df.select(column(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))


def summaries(df: DataFrame, words: int) -> DataFrame:
    """``id, digest, size, name, sketch`` of each row of ``id, text, digest``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                own = _set_of(text.as_py(), words)
                rows.append((len(own), _signature(own), dense_sketch(own)))
            kinds = (pa.int64(), pa.int64(), pa.binary())
            made = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *made], ["id", "digest", "size", "name", "sketch"]
            )

    return df.mapInArrow(made, "id long, digest long, size long, name long, sketch binary")


def postings(df: DataFrame, words: int, likeness: tuple[int, int]) -> DataFrame:
    """``key, name`` for the blocks of each set; copies met in one task are posted once."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            names, keys = [], []
            for text in batch.column(1):
                own = _set_of(text.as_py(), words)
                name = _signature(own)
                if not len(own) or name in seen:
                    continue
                seen.add(name)
                band = len(own).bit_length() - 1
                found = [block_keys(own, band, likeness)]
                if len(own) * likeness[1] // likeness[0] >= 2 << band:
                    found.append(block_keys(own, band + 1, likeness))
                keys.append(np.concatenate(found))
                names.append(np.full(len(keys[-1]), name, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], ["key", "name"]
                )

    return df.mapInArrow(posted, "key long, name long")


def shared_blocks(posted: DataFrame) -> DataFrame:
    """``run, members, chunk, chunks, name``: the sets that share a block, once for each list of sets.

    Keys are brought together and sorted, and their runs are read as a stream, so that
    a task holds the names of one run; runs of a single set end here. Long runs are cut
    into chunks. Runs with the same sets have the same name and become one.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_keys, rest_names = np.empty(0, np.int64), np.empty(0, np.int64)

        def emitted(keys: np.ndarray, names: np.ndarray) -> Iterator[pa.RecordBatch]:
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
            keys, names = keys[fresh], names[fresh]
            starts = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            sizes = np.diff(np.append(starts, len(keys)))
            out = []
            for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                own = names[start : start + size]
                run = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
                chunk = np.arange(size) // _CHUNK
                out.append((np.full(size, run), np.full(size, size), chunk, np.full(size, chunk[-1] + 1), own))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([row[i] for row in out]).astype(np.int64)) for i in range(5)],
                    ["run", "members", "chunk", "chunks", "name"],
                )

        for batch in batches:
            keys = np.concatenate([rest_keys, batch.column(0).to_numpy()])
            names = np.concatenate([rest_names, batch.column(1).to_numpy()])
            if not len(keys):
                continue
            # The last run may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            rest_keys, rest_names = keys[cut:], names[cut:]
            if cut:
                yield from emitted(keys[:cut], names[:cut])
        if len(rest_keys):
            yield from emitted(rest_keys, rest_names)

    together = posted.repartition("key").sortWithinPartitions("key", "name")
    return together.mapInArrow(runs, "run long, members long, chunk long, chunks long, name long").distinct()


def close_pairs(members: DataFrame, likeness: tuple[int, int], only_first: bool) -> DataFrame:
    """``a, b``: sets that share a block and whose sizes and sketches let them be alike.

    ``members`` has ``run, chunk, chunks, name, size, sketch, root``. Chunks of a run meet two by
    two. With ``only_first`` each set is paired with the first such set of its run (and
    chunk), so that the pairs of a run of copies are no more than its rows; else
    with all of those that have another root.
    """
    p, q = likeness
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    met = members.withColumn("other", other).select(
        "run", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"),
        (F.col("chunk") == F.least("chunk", "other")).alias("is_one"), "name", "size", "sketch", "root",
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def close() -> Iterator[pa.RecordBatch]:
            names = np.array([row[4] for row in held], np.int64)
            sizes = np.array([row[5] for row in held], np.int64)
            bits = folded([row[6] for row in held])
            roots = np.array([row[7] for row in held], np.int64)
            is_one = np.array([row[3] for row in held])
            same = at[1] == at[2]
            free = np.ones(len(held), bool)
            for i in np.flatnonzero(is_one).tolist():
                j = np.arange(i + 1, len(held)) if same else np.flatnonzero(~is_one)
                j = j[free[j] if only_first else roots[j] != roots[i]]
                # The smaller may be no smaller than p / q of the larger.
                low, high = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
                j = j[low * q >= high * p]
                apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                j = j[apart * (q + p) <= (sizes[i] + sizes[j]) * (q - p)]
                if len(j):
                    free[j] = False
                    first = np.full(len(j), names[i])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(first, names[j])), pa.array(np.maximum(first, names[j]))], ["a", "b"]
                    )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at:
                    if at is not None:
                        yield from close()
                    held, at = [], row[:3]
                held.append(row)
        if at is not None:
            yield from close()

    together = met.repartition("run", "one", "two").sortWithinPartitions("run", "one", "two", "name")
    return together.mapInArrow(pairs, "a long, b long").distinct()


def set_members(texts: DataFrame, words: int) -> DataFrame:
    """``name, own``: the members of the sets of rows ``name, text``.

    Copies bring a text several times, and two texts may have one digest: what doesn't have
    the set of that name is left out, as is a set met before in the task.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found: dict[int, bytes] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if name not in seen and _signature(own := _set_of(text.as_py(), words)) == name:
                    seen.add(name)
                    found[name] = own.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([*found], pa.int64()), pa.array([*found.values()], pa.binary())], ["name", "own"]
            )

    return texts.mapInArrow(members, "name long, own binary")


def verified(pairs: DataFrame, sets: DataFrame, likeness: tuple[int, int]) -> DataFrame:
    """``u, v``: the pairs ``a, b`` whose sets are alike, counted member by member."""
    p, q = likeness

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(one.as_py(), _U), np.frombuffer(two.as_py(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(q * both >= p * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("name").alias("a"), F.col("own").alias("own_a"))
    second = sets.select(F.col("name").alias("b"), F.col("own").alias("own_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "own_a", "own_b").mapInArrow(alike, "u long, v long")


def group_alike(
    df: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    likeness: tuple[int, int] = (4, 5),
) -> DataFrame:
    """The identifier, ``n_shingles`` and ``component_id`` of every row.

    A row's set holds its shingles of ``words`` lower-case words; of fewer words, the
    whole sequence. Two rows are linked if their sets' intersection is at least
    ``likeness`` (as a fraction) of their union; ``component_id`` is the smallest
    identifier reachable by links, itself included. Rows whose text is null or has no word have size 0 and
    are linked with nothing. Rows with the same set, and so repeated rows, become one
    before sets are paired. Identifiers are numbers; a null one counts as larger
    than all others. Other columns don't matter. An empty table gives no rows.
    Sets are named, and shingles compared, by 64-bit hashes.
    """
    joined = _classes(df, id_column, text_column, words, likeness)
    smallest = joined.where("size > 0").groupBy("class").agg(F.min("id").alias("component_id"))
    return joined.join(smallest, "class", "left").select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one(
    df: DataFrame,
    *,
    columns: list[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    likeness: tuple[int, int] = (4, 5),
) -> DataFrame:
    """One row of each group of like rows (see ``group_alike``), whatever their identifiers.

    That is a row with the smallest identifier, a null one being larger than all others; of
    several, the one whose text has the smallest hash, and of equal texts any. Rows whose text is
    null or has no word are like none and all stay. An empty table gives no rows.
    """
    classes = stage(_classes(df, id_column, text_column, words, likeness))
    texts = classes.where("size > 0").groupBy("class", F.col("id").isNull().alias("last"), "id", "digest").agg(
        F.count(F.lit(1)).alias("n")
    )
    first = texts.groupBy("class").agg(F.min(F.struct("last", "id", "digest", "n")).alias("x"))
    empty = classes.where("size = 0").select("id", "digest", F.lit(1).cast("long").alias("n")).distinct()
    chosen = stage(first.select("x.id", "x.digest", "x.n").unionByName(empty).withColumnsRenamed({"id": "_of", "digest": "_which", "n": "_rows"}))
    text = F.coalesce(column(text_column), F.lit(""))
    own = column(id_column).cast("long").eqNullSafe(F.col("_of")) & (F.xxhash64(text) == F.col("_which"))
    wanted = [column(c) for c in columns]
    kept = df.select(*wanted).join(chosen.where("_rows = 1").drop("_rows"), own, "left_semi")
    if not chosen.where("_rows > 1").limit(1).count():
        return kept
    # Equal rows of one identifier, of which any stays.
    repeated = df.select(*wanted).join(chosen.where("_rows > 1").drop("_rows"), own)
    one = repeated.groupBy("_of", "_which").agg(F.first(F.struct(*wanted)).alias("_row")).select("_row.*")
    return kept.unionByName(one)


def _classes(df: DataFrame, id_column: str, text_column: str, words: int, likeness: tuple[int, int]) -> DataFrame:
    """``id, digest, size, class`` of every row; rows of a class are linked, and the class of size 0 is null."""
    rows = _sets(df, id_column, text_column)
    known = stage(summaries(rows, words))
    sets = known.where("size > 0").groupBy("name").agg(
        F.min("digest").alias("digest"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )
    runs = stage(shared_blocks(postings(rows, words, likeness)))
    sketched = runs.join(sets.drop("digest"), "name").withColumn("root", F.col("name"))
    # First every set is compared with one of each run, which joins most copies; then, in runs of
    # three or more, all that are still apart. Pairs within a component change nothing.
    pairs = stage(close_pairs(sketched, likeness, only_first=True))
    members = _members_of(pairs, rows, sets, words)
    links = stage(verified(pairs, members, likeness))
    discard(members)
    roots = stage(components(links))
    parts = runs.where("members > 2").join(roots, runs["name"] == roots["node"], "left").select(
        *runs.columns, F.coalesce("root", "name").alias("root")
    )
    split = parts.groupBy("run").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    apart = parts.join(split.select("run"), "run", "left_semi").join(sets.drop("digest"), "name")
    more = stage(close_pairs(apart, likeness, only_first=False).join(pairs, ["a", "b"], "left_anti"))
    discard(runs, pairs, roots)
    members = _members_of(more, rows, sets, words)
    found = stage(verified(more, members, likeness))
    discard(members, more)
    roots = stage(components(links.unionAll(found)))
    discard(links, found)
    return known.join(roots, known["name"] == roots["node"], "left").select(
        "id", "digest", "size", F.when(F.col("size") > 0, F.coalesce("root", "name")).alias("class")
    )


def _members_of(pairs: DataFrame, rows: DataFrame, sets: DataFrame, words: int) -> DataFrame:
    """``name, own`` for each set in a pair, from a text that has it, staged.

    The text is looked up by its digest: every row meets one set at most, whatever its identifier.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    chosen = stage(sets.join(wanted, "name", "left_semi").select("name", "digest"))
    members = stage(set_members(rows.join(chosen, "digest").select("name", "text"), words))
    discard(chosen)
    return members
