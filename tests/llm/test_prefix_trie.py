"""The trie of conversation prefixes against brute force, and its defined cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn int, role string, text string, depth int, node string, words string, parent int, shard int, n int"
OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turns_of(spark, rows):
    """Turns with more columns, named like those that the operator makes itself."""
    return spark.createDataFrame([(*row, 1, "x", "y", 2, 3, 4) for row in rows], TURNS)


def digest_order(row):
    turn, role, text = row[1], row[2] or "", row[3] or ""
    md5 = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, role, md5)


def brute(rows):
    """All nodes of the rebuilt conversations."""
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=digest_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return nodes_of(rebuilt)


def nodes_of(rebuilt):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
        ends[tuple(rebuilt[c])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (m[0], len(node), members[node[:-1]][0] if node else -1, len(m), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, m in members.items()
    )


def found(df):
    assert sorted(df.columns) == sorted(OUT)
    return sorted(tuple(-1 if row[c] is None else row[c] for c in OUT) for row in df.select(*OUT).collect())


def random_rows(seed, n):
    rng, rows = random.Random(seed), []
    texts = ["", "yes", "no no", "a longer text", "é ü", None]
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.choice((1, 1, 2, 3, 5, 9))):
            rows.append((c, turn, rng.choice(("user", "assistant", None)), rng.choice(texts) if rng.random() < 0.9 else f"only {c}"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [15, 100_000])
def test_all_nodes(spark, shard_turns):
    rows = random_rows(1, 150)
    convs = prefix_trie.branched(prefix_trie.conversations(turns_of(spark, rows)))
    assert found(prefix_trie.prefix_nodes(convs, shard_turns=shard_turns)) == brute(rows)


def test_hot_beginnings_are_split_and_merged(spark):
    """A third of the conversations is equal, another shares its first turns; shards are tiny."""
    rows = []
    for c in range(300):
        if c % 3 == 0:
            rows += [(c, t, "user", f"hot {t}") for t in range(4)]
        elif c % 3 == 1:
            rows += [(c, t, "user", f"hot {t}") for t in range(3)] + [(c, 3, "user", f"own {c % 40}"), (c, 4, "user", f"own {c}")]
        else:
            rows += [(c, 0, "user", f"cold {c}")]
    whole = prefix_trie.conversations(turns_of(spark, rows))
    expected = defaultdict(list)
    for c, _, role, text in rows:
        expected[c].append((role, text))
    assert found(prefix_trie.prefix_nodes(whole, shard_turns=20)) == nodes_of(expected)


def test_odd_turns(spark):
    rows = [
        (None, 0, "user", "lost"), (7, None, "user", "last"), (7, 0, None, None), (7, 0, None, None), (7, 1, "", ""),
        (7, None, "user", "last"), (20, 0, "user", "x" * 300_000), (21, 0, "user", "word " * 20_000), (22, 0, "user", " \t"),
        (-1, 0, "a", "b"), (-20, 0, "a", "b"), (23, 0, "r:", "t"), (24, 0, "r", ":t"),
    ]
    plain = prefix_trie.conversations(turns_of(spark, rows))
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=digest_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    assert found(prefix_trie.prefix_nodes(plain)) == nodes_of(own)


def test_turnless_and_absent(spark):
    # 1 % 20 points to conversation 0, which is absent; what is left of a short one may be nothing.
    ids = [c for c in range(1, 60) if c != 20]
    rows = [(c, 0, "user", f"t {c % 3}") for c in ids]
    assert any(c % 20 and zlib.crc32(str(c).encode()) % 4 for c in ids)
    nodes = found(prefix_trie.prefix_nodes(prefix_trie.branched(prefix_trie.conversations(turns_of(spark, rows)))))
    assert nodes == brute(rows)
    root = [node for node in nodes if node[1] == 0]
    assert root[0][-1] != hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    empty = prefix_trie.branched(prefix_trie.conversations(turns_of(spark, [])))
    assert prefix_trie.prefix_nodes(empty).collect() == []


def test_one_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (0, 1, 2) for t in range(500 + c)]
    convs = prefix_trie.conversations(turns_of(spark, rows))
    own = {c: [("user", f"turn {t}") for t in range(500 + c)] for c in (0, 1, 2)}
    assert found(prefix_trie.prefix_nodes(convs, shard_turns=200)) == nodes_of(own)


@pytest.mark.parametrize("seed", range(5))
def test_double_array_holds_exactly_its_sequences(seed):
    rng = np.random.default_rng(seed)
    sequences = sorted({tuple(rng.integers(1, 30, rng.integers(0, 7))) for _ in range(400)})
    lengths = np.array([len(s) for s in sequences])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    trie = prefix_trie.DoubleArray(np.array([c for s in sequences for c in s], dtype=np.int64), starts, lengths)
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    nodes = {(): 0}
    for prefix in sorted(prefixes, key=len)[1:]:
        slot = int(trie.step(np.array([nodes[prefix[:-1]]]), np.array([prefix[-1]]))[0])
        assert slot > 0 and slot not in nodes.values()
        nodes[prefix] = slot
    # No other step leads anywhere, and no slot is used besides.
    for prefix, slot in nodes.items():
        steps = np.arange(0, 35)
        there = trie.step(np.full(35, slot), steps) >= 0
        assert set(steps[there].tolist()) == {c for c in range(35) if (*prefix, c) in prefixes}
    assert (trie.check >= 0).sum() == len(prefixes)


def test_hot_identifier_lists_are_hashed_in_blocks(spark):
    ends = spark.range(10_000).select(
        F.when(F.col("id") % 7 > 0, b"hot").otherwise(F.col("id").cast("string").cast("binary")).alias("node"), F.col("id").alias("conv_id")
    )
    hot = ",".join(str(i) for i in range(10_000) if i % 7)
    rows = {bytes(r["node"]): r["ends_sha256"] for r in prefix_trie.id_digests(ends).collect()}
    assert rows[b"hot"] == hashlib.sha256(hot.encode()).hexdigest()
    assert rows[b"14"] == hashlib.sha256(b"14").hexdigest() and len(rows) == 1 + len(range(0, 10_000, 7))
