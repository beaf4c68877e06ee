"""Sharding by virtual slots against brute force, and its defined cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewright.llm import queries, slots

SHARDED = "doc_id long, text string, shard int, virtual_slot int, size string, id string, slot int"


def sharded_docs(spark, rows):
    return spark.createDataFrame([(i, t, 99, 99, "s", "i", 9) for i, t in rows], SHARDED)


def check_places(rows):
    places = defaultdict(list)
    for row in rows:
        places[row["shard"]].append(row["place"])
    assert all(sorted(own) == list(range(len(own))) for own in places.values())


def test_every_row_once_with_its_size_and_a_gapless_place(spark, folder):
    rng = random.Random(3)
    texts = [(i, rng.choice(["", "a", "é" * 7, "word " * rng.randrange(400)])) for i in range(3_000)]
    rows = slots.shard_documents(sharded_docs(spark, texts), folder + "/maps", shards=7, slots=512).collect()
    expected = Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts)
    assert Counter((row["doc_id"], row["size"], row["text_crc32"]) for row in rows) == expected
    check_places(rows)
    loads = Counter()
    for row in rows:
        loads[row["shard"]] += row["size"]
    assert len(loads) == 7 and max(loads.values()) - min(loads.values()) <= 0.001 * sum(loads.values()) / 7
    # A slot is in one shard, the one that the stored map says.
    stored = slots.SlotMaps(spark, folder + "/maps").load()
    assert {(row["virtual_slot"], row["shard"]) for row in rows} <= set(enumerate(stored.shard_of.tolist()))


def test_odd_rows(spark, folder):
    odd = [(None, None), (None, None), (None, "x"), (5, None), (5, ""), (5, "same"), (5, "same"), (6, "long " * 200_000)]
    rows = slots.shard_documents(sharded_docs(spark, odd), folder + "/maps", shards=4, slots=64).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd
    )
    check_places(rows)


def test_rows_without_identifier_are_spread(spark, folder):
    rows = slots.shard_documents(
        sharded_docs(spark, [(None, f"text {i}") for i in range(2_000)]), folder + "/maps", shards=8, slots=256
    ).collect()
    counts = Counter(row["shard"] for row in rows)
    assert len(counts) == 8 and max(counts.values()) <= 1.1 * min(counts.values())


def test_empty_table(spark, folder):
    assert slots.shard_documents(sharded_docs(spark, []), folder + "/maps", shards=4, slots=64).collect() == []
    assert slots.SlotMaps(spark, folder + "/maps").versions() == [1, 2]


def test_reruns_agree(spark, folder):
    rows = sharded_docs(spark, [(i, "w " * (i % 50)) for i in range(500)])
    first, second = (
        sorted(slots.shard_documents(rows.repartition(n), f"{folder}/{n}", shards=5, slots=128).collect()) for n in (1, 7)
    )
    assert first == second


@pytest.mark.parametrize("seed", range(6))
def test_rebalancing_evens_out_and_moves_little(seed):
    rng = np.random.default_rng(seed)
    totals = np.stack([(rng.pareto(1.5, 1_024) * 1_000).astype(np.int64) + 1, np.ones(1_024, np.int64)], axis=1)
    old = slots.first_map(8, totals)
    new = slots.rebalanced(old)
    # A slot larger than a share is a shard; the others are even.
    single = {int(new.shard_of[slot]) for slot in np.flatnonzero(totals[:, 0] >= new.shard_bytes.mean())}
    rest = np.array([size for shard, size in enumerate(new.shard_bytes) if shard not in single])
    assert rest.max() - rest.min() <= 0.001 * rest.mean()
    assert (new.shard_of != old.shard_of).sum() <= 0.4 * len(totals)
    assert new.shard_bytes.sum() == totals[:, 0].sum() and new.version == 2
    # A map that is even already stays as it is.
    assert (slots.rebalanced(new).shard_of == new.shard_of).all()


def test_a_new_shard_takes_slots_only_into_itself():
    rng = np.random.default_rng(1)
    totals = np.stack([rng.integers(1, 1_000, 2_048), np.ones(2_048, np.int64)], axis=1)
    old = slots.rebalanced(slots.first_map(24, totals))
    new = slots.grown(old)
    moved = new.shard_of != old.shard_of
    assert set(new.shard_of[moved]) == {24} and new.shards == 25
    assert abs(new.shard_bytes[24] - totals[:, 0].sum() / 25) <= 1_000
    assert new.shard_bytes[:24].min() >= totals[:, 0].sum() / 25 - 1_000


def test_versions_are_kept_and_not_overwritten(spark, folder):
    totals = np.array([[5, 1], [9, 2], [3, 1], [7, 1]])
    maps = slots.SlotMaps(spark, folder + "/maps")
    assert maps.versions() == []
    first = maps.save(slots.first_map(2, totals))
    second = maps.save(slots.rebalanced(first))
    assert maps.versions() == [1, 2]
    assert (maps.load().shard_of == second.shard_of).all() and (maps.load(1).shard_of == first.shard_of).all()
    assert (maps.load().totals == totals).all()
    with pytest.raises(PySparkException, match="version 2 .* exists"):
        maps.save(slots.rebalanced(first))
    assert maps.versions() == [1, 2]
    with pytest.raises(PySparkException, match="no version 9"):
        maps.frame(9)


def test_written_shards_hold_their_slots_rows(spark, folder):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"), F.lit(1).alias("bytes"))
    maps = slots.SlotMaps(spark, folder + "/maps")
    sized = rows.select(slots.slot_number([F.col("doc_id")], 64).alias("virtual_slot"), slots.text_size(F.col("text")).alias("size"))
    totals = slots.slot_totals(sized, 64)
    maps.save(slots.rebalanced(slots.first_map(3, totals)))
    slots.write_shards(rows, maps, folder + "/out", slots=64)
    back = spark.read.parquet(folder + "/out")
    assert sorted(r["doc_id"] for r in back.collect()) == list(range(400))
    sizes = {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()}
    assert {s: 11 * n for s, n in sizes.items()} == dict(enumerate(maps.load().shard_bytes.tolist()))


def test_query_covers_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.op11_sharding(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()
    }
    assert {r["shard"] for r in rows} == set(range(24)) and {r["law"] for r in rows} == {"bytes"}
    assert {r["grown_shard"] for r in rows} == {None}
