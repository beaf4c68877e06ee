"""The corpus operators against brute force, and their defined cases: nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import base64
import hashlib
import io
import os
import random
import re
import struct
from urllib.parse import unquote

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from tidewright.llm import chat, components, html_text, jaccard, langid, mixing, nearest, passages, pieces, simhash, warc
from tidewright.llm.queries import held_out

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, lang string, size int, digest string, bucket int, name string"


def docs(spark, rows):
    """Documents with more columns, named like those that operators make themselves."""
    return spark.createDataFrame([(i, t, s, "en", 1, "x", 2, "y") for i, t, s in rows], DOCS)


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def prose(seed, n):
    return " ".join(random.Random(seed).choices([a + b for a in "bdfglmnprst" for b in ("a", "en", "ir", "ould")], k=n))


ODD = [(1, None, "a"), (2, "", None), (3, " \t ", "b"), (None, "one two", "a"), (4, "one", "a"), (4, "one", "a")]


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 7), (3, 1), (1, 3), (20, 9)], "u long, v long")
    found = {row["node"]: row["root"] for row in components.components(links).collect()}
    assert found == {9: 7, 8: 7, 20: 7, 3: 1}
    chain = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {row["root"] for row in components.components(chain).collect()} == {0}


def brute_components(texts, least=(4, 5)):
    sets = {}
    for doc, text in texts.items():
        own = words_of(text)
        sets[doc] = {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())
    root = {doc: doc for doc in texts}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in texts:
        for b in texts:
            if a < b and sets[a] and least[1] * len(sets[a] & sets[b]) >= least[0] * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc: (len(sets[doc]), find(doc)) for doc in texts}


def test_jaccard_join(spark):
    rng, texts = random.Random(5), {}
    for i in range(150):
        texts[i] = prose(i, rng.choice((1, 3, 6, 9, 30, 120, 700)))
    for i in range(150, 300):
        own = texts[rng.randrange(i)].split()
        for _ in range(rng.choice((0, 1, 2, 4))):
            own[rng.randrange(len(own))] = "changed"
        texts[i] = " ".join(own).upper() if i % 7 == 0 else " ".join(own)
    rows = jaccard.group_alike(docs(spark, [(i, t, "s") for i, t in texts.items()])).collect()
    assert {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows} == brute_components(texts)
    odd = sorted(tuple(row) for row in jaccard.group_alike(docs(spark, ODD[:3] + ODD[4:])).collect())
    assert odd == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4)]
    assert jaccard.group_alike(docs(spark, ODD)).count() == len(ODD)
    assert jaccard.group_alike(docs(spark, [])).count() == 0


def test_block_keys_meet_for_all_like_sets():
    rng = np.random.default_rng(3)
    for _ in range(400):
        size = int(rng.integers(1, 400))
        one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        most = jaccard.most_apart(len(one), (4, 5))
        gone = int(rng.integers(0, most + 1))
        two = np.unique(np.concatenate([one[gone:], rng.integers(0, 1 << 63, most - gone, dtype=np.uint64)]))
        both = len(np.intersect1d(one, two))
        if 5 * both < 4 * (len(one) + len(two) - both):
            continue
        bands = {len(one).bit_length() - 1, len(two).bit_length() - 1}
        assert max(bands) - min(bands) <= 1
        keys = [set(jaccard.block_keys(s, max(bands), (4, 5)).tolist()) for s in (one, two)]
        assert keys[0] & keys[1]


def test_compact_windows():
    rng = np.random.default_rng(1)
    for length in (1, 2, 5, 46):
        for n in (0, length - 1, length, 130):
            values = rng.integers(0, 50, max(n, 0)).astype(np.uint64)
            covered = {}
            for c, a, b in passages.compact_windows(values, length):
                for i in range(a, c + 1):
                    for j in range(max(c, i + length - 1), b + 1):
                        assert (i, j) not in covered
                        covered[i, j] = c
            assert covered == {
                (i, j): i + int(values[i : j + 1].argmin()) for i in range(len(values)) for j in range(i + length - 1, len(values))
            }


def test_repeated_passages(spark):
    shared, near = prose("p", 60), prose("q", 80).split()
    near[40] = "changed"
    rows = [(i, prose(i, 90), "s") for i in range(20)]
    rows += [(30 + i, f"{prose(i + 50, 30)}\n{shared}\n{prose(i + 90, 20 + i)}", "s") for i in range(12)]
    rows += [(60, prose("q", 80), "s"), (61, " ".join(near), "s"), (62, "was " * 300, "s"), (63, "was " * 200, "s")]
    df = docs(spark, rows + ODD)
    found = {row["doc_id"]: (row["start_word"], row["end_word"], row["first_id"]) for row in passages.repeated_passages(df).collect()}
    assert set(found) == {*range(31, 42), 61, 63}
    # A word or two of the surroundings may be alike by chance.
    assert all(28 <= found[i][0] <= 30 and 90 <= found[i][1] <= 92 and found[i][2] == 30 for i in range(31, 42)), found
    assert found[61][2] == 60
    left = {row["doc_id"]: row["text"] for row in passages.drop_repeats(df, columns=["doc_id", "text"]).collect()}
    assert left[30].count(shared) == 1 and shared not in left[31] and left[31].startswith(prose(51, 30))
    assert left[5] == prose(5, 90) and left[2] == "" and left[1] is None and 63 not in left
    assert passages.repeated_passages(docs(spark, [])).count() == 0


def test_passages_belong_to_a_text_of_an_identifier(spark):
    shared = prose("p", 60)
    rows = [(1, f"{prose(1, 40)} {shared}", "s"), (2, f"{prose(2, 80)} {shared} {prose(3, 5)}", "s")]
    rows += [(2, prose(4, 20), "s"), (2, prose(5, 200), "s"), (3, prose(6, 70), "s"), (3, f"{shared} {prose(7, 90)}", "s")]
    df = docs(spark, rows)
    found = [(r["doc_id"], r["first_id"]) for r in passages.repeated_passages(df).collect()]
    assert sorted(found) == [(2, 1), (3, 1)]
    left = sorted(r["text"] for r in passages.drop_repeats(df, columns=["doc_id", "text"]).collect())
    clean = [rows[i][1] for i in (0, 2, 3, 4)]
    assert len(left) == 6 and all(text in left for text in clean)
    assert sum(shared in text for text in left) == 1


def test_passages_of_frequent_lines(spark):
    for trial, n in enumerate((30, 40, 45)):
        rows, pairs = [], []
        for case in range(8):
            first, second = prose(f"A{trial}.{case}", n), prose(f"B{trial}.{case}", n)
            for i in range(40):
                doc = 1_000 * case + i
                before, after = prose(f"x{trial}.{doc}", 50), prose(f"y{trial}.{doc}", 50)
                # Two of them hold both lines, one after the other.
                line = f"{first} {second}" if i in (17, 31) else (first, second)[i % 2]
                rows.append((doc, f"{before} {line} {after}", "s"))
            pairs.append((1_000 * case + 31, 1_000 * case + 17))
        found = {r["doc_id"]: r for r in passages.repeated_passages(docs(spark, rows)).collect()}
        assert [(i, found[i]["first_id"]) for i, _ in pairs if i in found] == pairs and len(found) == len(pairs)
        for i, _ in pairs:
            assert 48 <= found[i]["start_word"] <= 50 and 50 + 2 * n <= found[i]["end_word"] <= 52 + 2 * n


def test_passages_shuffle_contexts_once(spark, monkeypatch):
    """Of the tables staged on the way one has contexts, and equal stretches are told apart in chunks of any size."""
    line, rows = prose("line", 40), []
    for i in range(60):
        # Six of them go on alike.
        after = prose("after", 30) if i % 10 == 7 else prose(f"y{i}", 30)
        rows.append((i, f"{prose(f'x{i}', 50)} {line} {after} {prose(f'z{i}', 40)}", "s"))
    staged, stage = [], passages.stage
    monkeypatch.setattr(passages, "stage", lambda df: staged.append(df.columns) or stage(df))
    for sizes in ((2_048, 8_192), (3, 5), (1, 1)):
        monkeypatch.setattr(passages, "_OPEN_CHUNK", sizes[0])
        monkeypatch.setattr(passages, "_CHUNK", sizes[1])
        staged.clear()
        found = sorted((r["doc_id"], r["first_id"]) for r in passages.repeated_passages(docs(spark, rows)).collect())
        assert found == [(i, 7) for i in (17, 27, 37, 47, 57)]
        assert sum("context" in columns for columns in staged) == 1, staged


def test_windows_meet_some_alike_first(spark, monkeypatch):
    """Pairs of the first round grow with the windows, not with their square; the rest are those that all have besides."""
    line, n = prose("shared", 60), 40
    rows = [(i, f"{prose(f'x{i}', 50)} {line} {prose(f'z{i}', 40)}", "s") for i in range(n)]
    texts = docs(spark, rows).select(*passages._texts("doc_id", "text"))
    found = passages.windows(texts, words=5, length=46, hashes=1)
    marked = found.join(found.groupBy("key").count().where(f"count = {n}"), "key").drop("count").withColumn("open", F.lit(True))
    assert marked.count() >= n
    monkeypatch.setattr(passages, "_PART_ROWS", 10)

    def met(low, most):
        used = []
        pairs = passages.later_meetings(marked, texts, used, (low, most), words=5, length=46, likeness=(4, 5))
        got = {(r["a"], r["b"]) for r in passages.stretches(pairs, 1).collect()}
        passages.discard(*used)
        return {(a, b) for a, b in got if a < b}, {b for a, b in got if a == b}

    all_pairs, none_short = met(0, float("inf"))
    assert len(all_pairs) > n * n // 4 and not none_short
    few, short = met(0, 3)
    assert len(few) <= 3 * marked.count() and len(few) < len(all_pairs) // 3 and len(short) > n // 2
    rest, _ = met(3, float("inf"))
    assert few | rest == all_pairs


def test_passages_in_rounds_and_parts(spark, monkeypatch):
    """However few are met first and however many parts there are, what all would find is found."""
    lines = [prose(f"line{k}", 40) for k in range(2)]
    rows = []
    for i in range(50):
        after = prose(f"after{i % 3}", 30) if i % 5 == 2 else prose(f"y{i}", 30)
        rows.append((i, f"{prose(f'x{i}', 50)} {lines[i % 2]} {after} {prose(f'z{i}', 40)}", "s"))
    want = None
    for sizes in ((32, 1 << 23, 1 << 21), (1, 20, 5)):
        for name, value in zip(("_ALIKE", "_PART_ROWS", "_PART_STRETCHES"), sizes):
            monkeypatch.setattr(passages, name, value)
        found = sorted(tuple(r) for r in passages.repeated_passages(docs(spark, rows)).collect())
        want = want or found
        assert found and found == want


def test_digests_tell_apart_only_texts_of_one_identifier(spark):
    copy = prose("copy", 80)
    rows = [(1, copy, "s"), (2, copy, "s"), (2, None, "s"), (3, prose("own", 80), "s"), (3, f"{copy} end", "s")]
    texts = docs(spark, rows).select(*passages._texts("doc_id", "text")).dropna()
    assert {(r["id"], r["digest"] == 0) for r in passages._told_apart(texts).collect()} == {(1, True), (2, True), (3, False)}
    kept = passages.drop_repeats(docs(spark, rows), columns=["doc_id", "text"]).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"]) == [(1, copy), (3, "end"), (3, prose("own", 80))]
    assert [r["doc_id"] for r in kept if r["text"] is None] == [2]


def test_islands_are_put_together_in_any_order():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(2, 80))
        table = np.zeros((11, n), np.int64)
        table[0], table[5] = rng.integers(0, 2, n), rng.choice([-40, 0, 20, 50, 82, 115, 300], n)
        table[8] = rng.integers(0, 400, n)
        table[9] = table[8] + rng.integers(5, 40, n)
        table[6:8], table[10] = table[8:10] - table[5], table[5]
        cut = int(rng.integers(1, n))
        parts = np.concatenate([passages._put_together(table[:, :cut]), passages._put_together(table[:, cut:])], axis=1)
        ends = lambda t: sorted(zip(*passages._put_together(t)[[0, 5, 6, 7, 8, 9, 10]].tolist()))
        assert ends(parts) == ends(table)


def test_islands_of_windows():
    """Against brute force, at once and with windows of one function and diagonal joined before."""
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 60))
        table = np.zeros((10, n), np.int64)
        table[0], table[4], table[5] = rng.integers(0, 2, n), rng.integers(0, 3, n), rng.choice([0, 5, 30, 70, 200], n)
        table[8] = rng.integers(0, 300, n)
        table[9] = table[8] + rng.integers(5, 40, n)
        table[6:8] = table[8:] - table[5]
        want = set()
        for pair in (0, 1):
            lanes, last = [], None
            for row in sorted(table[:, table[0] == pair].T.tolist(), key=lambda r: (r[5], r[8], r[9])):
                if last is None or row[5] - last > 32:
                    lanes.append([])
                lanes[-1].append(row)
                last = row[5]
            for lane in lanes:
                island, islands = [], []
                for row in sorted(lane, key=lambda r: (r[8], r[9])):
                    if island and row[8] > max(r[9] for r in island):
                        islands, island = [*islands, island], []
                    island.append(row)
                want |= {
                    (pair, *(pick(r[i] for r in rows) for i, pick in zip((6, 7, 8, 9), (min, max, min, max))), len({r[4] for r in rows}))
                    for rows in [*islands, island]
                }
        for given in (table, passages._overlapping(table)):
            order, island = passages._islands(given, (given[0],), 32)
            out = passages._joined(given, order, island)
            functions = [len(np.unique(given[4][order][island == i])) for i in range(out.shape[1])]
            assert {(*(int(out[i, k]) for i in (0, 6, 7, 8, 9)), functions[k]) for k in range(out.shape[1])} == want


def simhash_of(text):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    votes = [0] * 128
    for a, b in zip(own, [*own[1:], ""]):
        weight = min(len(a) + len(b), 15)
        h0 = xxhash.xxh64_intdigest(a.encode(), 42)
        h0 = xxhash.xxh64_intdigest(b.encode(), h0) if b else h0
        # Spark hashes the int 1, then the long.
        one = xxhash.xxh64_intdigest(struct.pack("<i", 1), 42)
        for half, h in enumerate((h0, xxhash.xxh64_intdigest(struct.pack("<Q", h0), one))):
            for bit in range(64):
                votes[64 * half + bit] += weight if h >> bit & 1 else -weight
    return f"{sum(1 << i for i, v in enumerate(votes) if v > 0):032x}"


def test_simhash(spark):
    rows = [(i, prose(i, i % 40), "s") for i in range(120)] + [(500, prose("l", 5000), "s"), (501, prose(7, 7), "s"), (502, None, None)]
    got = {row["doc_id"]: row for row in simhash.fingerprint_edits(docs(spark, rows)).collect()}
    order = sorted(((i, t or "") for i, t, _ in rows), reverse=True)
    assert len(got) == len(rows)
    for (doc, text), (_, after) in zip(order, [*order[1:], order[0]]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        row = got[doc]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == simhash_of(text) and row["edited_fingerprint"] == simhash_of(changed)
        apart = bin(int(simhash_of(text), 16) ^ int(simhash_of(after), 16)).count("1")
        assert row["near_next"] == 1 - apart / 128
    assert simhash.fingerprint_edits(docs(spark, ODD)).count() == len(ODD)
    assert simhash.fingerprint_edits(docs(spark, [])).count() == 0


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(128) for _ in range(60)]
    for value in values[:40]:
        for flips in range(1, 9):
            values.append(value ^ sum(1 << b for b in rng.sample(range(128), flips)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(v >> 64), signed(v & (1 << 64) - 1)) for v in values + values[:5]], "high long, low long")
    rows = simhash.within_radius(df, 6, 2).collect()
    pairs = [frozenset(((r["high_a"], r["low_a"]), (r["high_b"], r["low_b"]))) for r in rows]
    want = {
        frozenset(((signed(a >> 64), signed(a & (1 << 64) - 1)), (signed(b >> 64), signed(b & (1 << 64) - 1))))
        for a in values for b in values if a != b and bin(a ^ b).count("1") <= 6
    }
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_block_tables_are_not_broadcast(spark, folder):
    """A table of fingerprints under the limit for broadcasts has dozens of times its size in block tables."""
    spark.range(2_000).select(F.xxhash64("id").alias("high"), F.xxhash64(F.col("id") + 1).alias("low")).write.parquet(f"{folder}/prints")
    found = simhash.within_radius(spark.read.parquet(f"{folder}/prints"))
    assert found.count() == 0 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_pieces_equal_the_library(spark):
    file = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=file), pieces.PieceModel(open(file, "rb").read())
    texts = ["", " ", "  a  b ", "a▁b", "x\n\ty\x00z", "日本語😀é", "<s>hi</s><0x0A>", "ab" * 4000, " " * 70, prose(1, 500)]
    for text in texts:
        packed, ends = own.encode(text)
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert ids == library.encode(text, add_bos=True, add_eos=True) and own.decode(packed) == library.decode(ids)
        places = struct.unpack(f"<{len(ends) // 4}I", ends)
        assert list(places) == sorted(places) and places[-1] == len(text.encode())
    rows = pieces.encode(docs(spark, ODD), file, keep=["doc_id"]).collect()
    assert len(rows) == len(ODD) and [r["ids"] for r in rows if r["doc_id"] == 1] == [struct.pack("<2I", 1, 2)]
    assert pieces.encode(docs(spark, []), file, keep=["doc_id"]).count() == 0


def compiled_map(entries):
    """A double array for a few ASCII keys of one or two bytes, each node at a place of its own."""
    texts, units, used = b"", {}, {0}

    def free(children):
        base = 256
        while any(base ^ c in used for c in [0, *children]):
            base += 256
        return base

    def build(node, keys, label):
        nonlocal texts
        children = {}
        for key, value in keys.items():
            if key:
                children.setdefault(key[0], {})[key[1:]] = value
        base = free(children)
        used.update(base ^ c for c in [0, *children])
        units[node] = (node ^ base) << 10 | label | (256 if b"" in keys else 0)
        if b"" in keys:
            units[base] = 1 << 31 | len(texts)
            texts += keys[b""] + b"\0"
        for c, rest in children.items():
            build(base ^ c, rest, c)

    build(0, entries, 0)
    array = b"".join(struct.pack("<I", units.get(i, 0)) for i in range(max(used) + 256))
    return struct.pack("<I", len(array)) + array + texts


def test_character_map_takes_longest_prefixes():
    known = pieces.CharacterMap(compiled_map({b"f": b"F", b"fi": b"Y", b"\t": b" "}))
    assert known.longest(b"fix", 0)[0] == 2 and known.longest(b"fo", 0)[0] == 1 and known.longest(b"x", 0) is None
    own = pieces.PieceModel(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    own.characters, own.trims = known, True
    normal, origin = own.normalise(" fi\t f ")
    assert normal == "▁Y▁F" and origin.tolist() == [1, 1, 1, 1, 3, 3, 3, 5, 6]


def test_languages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(table.where(~held_out()))
    found = langid.identify(table, model, keep=["doc_id", "lang"]).where(held_out()).collect()
    assert sum(row["lang"] == row["lang_pred"] for row in found) >= 0.95 * len(found)
    odd = langid.identify(docs(spark, ODD + [(7, "12 , 34", "a")]), model, keep=["doc_id"]).collect()
    assert {r["doc_id"]: r["score"] for r in odd if r["lang_pred"] == langid.UNKNOWN} == {1: 0.0, 2: 0.0, 3: 0.0, 7: 0.0}
    none = langid.train(docs(spark, []))
    assert none.languages == () and langid.label_texts(none, ["word"], 8.0) == [("und", 0.0, [])]


def test_spans_of_mixed_text_and_best_paths():
    rng = np.random.default_rng(4)
    scores = -rng.random((60, 3)).astype(np.float32) * 6
    lengths = np.array([0, 7, 1, 0, 5, 47])
    path, at = langid._best_paths(scores, lengths, 3.0), 0
    for n in lengths.tolist():
        own, labels = scores[at : at + n], path[at : at + n]
        value = lambda p: sum(own[i, l] for i, l in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = np.zeros(3)
        for i in range(n):
            best = own[i] + (np.maximum(best, best.max() - 3.0) if i else 0)
        assert not n or value(labels.tolist()) == pytest.approx(best.max(), abs=1e-4)
        at += n
    parts = list(langid._pieces("a" * 2_500_000))
    assert "".join(p for _, p in parts) == "a" * 2_500_000 and max(len(p) for _, p in parts) <= langid._CHUNK_CHARS


def test_warc(spark, folder):
    pages = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (5, "u", ""), (None, "u", "none"), (9, "u", "é" * 300_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    manifest = warc.write_archives(df, folder, archive_bytes=200)
    rows = {row["page_id"]: row for row in warc.read_archives(manifest, folder).collect()}
    assert len(rows) == 6 and manifest.count() > 1
    assert {i: (r["record_type"], r["refers_to"]) for i, r in rows.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 5), 5: ("response", None), None: ("response", None), 9: ("response", None)}
    for i, _, html in pages:
        data = (html or "").encode()
        assert rows[i]["payload_bytes"] == len(data)
        assert rows[i]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert warc.archive_round_trip(df.where("page_id > 99")).count() == 0


def test_warc_dictionary_and_broken_records():
    samples = [f"<html><body>{prose(i, 60)}</body></html>".encode() for i in range(400)]
    dictionary = warc.train_dictionary(samples, 4096)
    packer = warc.compressor(dictionary)
    records = [warc.encode_record(i, "http://h/", s, None, False, "2024-01-01T00:00:00Z") for i, s in enumerate(samples[:20])]
    archive = warc.archive_head(dictionary) + b"".join(packer.compress(r) for r in records)
    assert dictionary and [r["payload"] for r in warc.read_archive(io.BytesIO(archive))] == samples[:20]
    with pytest.raises(warc.InvalidRecord):
        list(warc.read_archive(io.BytesIO(archive[:-3])))
    for old, new in ((b"Content-Length: ", b"Content-Length: 1"), (b"</html>", b"</htmk>"), (b"WARC/1.1", b"WARC/9.9"), (b"\r\n\r\n", b"\r\n")):
        with pytest.raises(warc.InvalidRecord):
            warc.decode_record(records[0].replace(old, new))


def test_warc_reads_urls_of_any_length():
    url = "data:text/plain," + "é" * 1_000_000
    record = warc.decode_record(warc.encode_record(1, url, b"page", None, False, "2024-01-01T00:00:00Z"))
    assert record["payload"] == b"page" and unquote(record["url"]) == url
    with pytest.raises(warc.InvalidRecord):
        warc.decode_record(b"WARC/1.1\r\n" + b"x" * 200_000)


def test_warc_samples_different_payloads(spark):
    rows = [(i, "hot" if i % 3 else f"page {i} " + "x" * 50) for i in range(9_000)] + [(9_000, None), (9_001, "")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    heads = {(html or "")[:12].encode() for _, html in rows} - {b""}
    got = warc.payload_sample(df, "html", 200, 12)
    assert len(got) == len(set(got)) == 200 and set(got) <= heads
    assert got == warc.payload_sample(df.repartition(7), "html", 200, 12)
    assert set(warc.payload_sample(df, "html", 20_000, 12)) == heads
    assert warc.payload_sample(df.where("page_id > 8999"), "html", 10, 12) == []


def test_warc_paths_are_in_the_default_file_system(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    for uri in ("hdfs://store/folder", "file:/folder", "s3://bucket/a"):
        assert warc.qualified(spark, uri) == uri
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "file:///")
        assert warc.qualified(spark, "archives").startswith("file:/")
        manifest = warc.write_archives(spark.createDataFrame([(1, "u", "p")], "page_id long, url string, html string"), f"{tmp_path}/a")
        assert [r["page_id"] for r in warc.read_archives(manifest, f"{tmp_path}/a").collect()] == [1]
    finally:
        conf.set("fs.defaultFS", before)


def test_simhash_neighbours_in_few_or_many_buckets(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 7, *range(60)]), rng.choice([None, "", f"text {i}"])) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = sorted((i is None, i or 0, t or "", order[(at + 1) % len(order)][1] or "") for at, (i, t) in enumerate(order))
    for settings in (dict(bucket_rows=10), dict(bucket_rows=10, most_buckets=3), dict(most_buckets=1)):
        got = simhash.next_to(df, "doc_id", "text", **settings).where("NOT guard").collect()
        assert sorted((r["id"] is None, r["id"] or 0, r["text"], r["next_text"]) for r in got) == want, settings
        assert len({r["bucket"] for r in got}) <= settings.get("most_buckets", 150)


def test_html(spark):
    shell = "<html><head><title>T</title></head><body><nav>menu</nav>{}<footer>f</footer></body></html>"
    article = "<article><h1>A &amp; B</h1><p>x<b>y</b>  z<br>w<p>v<div class='comments'>no</div><form>no</form></article>"
    notice = "<div>site notice</div>"
    pages = [
        (1, "http://h/a/1", shell.format("<div>aside</div>" + article)),
        (2, "http://h/b/1?x", shell.format(notice + "<p>only here</p>")),
        (3, "http://h/b/2", shell.format(notice + "<p>only there</p>")),
        (4, None, None), (5, "http://g/", "<p>alone <script>no</p></script>&lt;"), (6, "http://h/b/2", ""), (7, "x", "<"),
    ]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    got = {row["page_id"]: (row["text"], row["n_chars"]) for row in html_text.main_text(df).collect()}
    texts = {1: "A & B xy z w v", 2: "only here", 3: "only there", 4: "", 5: "alone <", 6: "", 7: "<"}
    assert got == {i: (t, len(t)) for i, t in texts.items()}
    assert html_text.main_text(df.where("page_id > 99")).count() == 0


def test_html_keeps_articles_in_named_wrappers():
    def text(body):
        lines = html_text.read_lines(f"<html><body>{body}</body></html>")
        return " ".join(line.text for line in lines if line.is_main) or " ".join(line.text for line in lines)

    body = "<article><p>the story</p><div class='related'>more</div></article>"
    for name in ("content-with-sidebar", "has-sidebar", "no-comments", "site-content search-results", "post-header-wrap", "search"):
        assert text(f"<div class='{name}'>{body}</div>") == "the story", name
        assert text(f"<div class='{name}'><div id=sidebar>{body}</div></div>") == "the story", name
    assert text("<article class='no-comments'>kept</article>") == "kept"
    assert text(body + "<div class='related'><article>card</article></div>") == "the story"
    assert text("<div class='search'><p>a long unmarked story</p><span class='share'>x</span></div><p>end</p>") == "a long unmarked story end"


def test_html_leaves_out_blocks_of_articles_by_parts_of_names():
    def text(body):
        lines = html_text.read_lines(f"<html><body>{body}</body></html>")
        return " ".join(line.text for line in lines if line.is_main) or " ".join(line.text for line in lines)

    for name in ("comments-area", "ad-slot", "adSlot", "share-buttons", "cookie-notice", "newsletter-signup", "post_comments"):
        assert text(f"<article><p>the story</p><div class='{name}'>no</div></article>") == "the story", name
    for name in ("comments-open", "no-comments", "has-sidebar", "adequate", "shareholders", "entry-header"):
        assert text(f"<article><p>the story</p><div class='{name}'>stays</div></article>") == "the story stays", name
    assert text("<article>code <span class='hljs-comment'># stays</span></article>") == "code # stays"
    # A header inside an article keeps the title, and nothing else; a page's own header goes.
    head = "<header><nav><h2>no</h2></nav><h1>Title</h1><p>by someone</p></header>"
    assert text(f"<header><h1>Site</h1></header><article>{head}<p>the story</p></article>") == "Title the story"
    assert text("<article><footer><h2>no</h2></footer><aside><header><h2>no</h2></header></aside>yes</article>") == "yes"
    # Comments longer than the story go, also where no article is marked.
    assert text("<div><p>story</p></div><div id='comments'>" + "<p>much longer than it</p>" * 9 + "</div>") == "story"


def test_html_lines_shared_with_the_nearest_page_choose_among_articles(spark):
    card = "<article><p>read this next</p><p>on every page</p></article>"
    pages = [
        # Cards are marked, the story isn't; then a story that is marked beside the card.
        (1, "http://h/a/1", f"<div>menu</div><div>the first story, unmarked but of a fair length</div>{card}"),
        (2, "http://h/a/2", f"<div>menu</div><div>the second story, unmarked but of a fair length</div>{card}"),
        (3, "http://h/b/1", f"<article><p>line</p><p>third</p></article>{card}<p>menu</p>"),
        (4, "http://h/b/2", f"<article><p>line</p><p>fourth</p></article>{card}<p>menu</p>"),
        # Copies of an article, between lines that differ.
        (5, "http://g/1", "<article><p>a story that two pages have</p></article><p>ad one</p>"),
        (6, "http://g/2", "<article><p>a story that two pages have</p></article><p>ad two</p>"),
        # Alone on its host, and equal pages.
        (7, "http://f/1", card + "<p>x</p>"), (8, "http://e/1", card), (9, "http://e/2", card),
    ]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[1] == "the first story, unmarked but of a fair length" and got[2] == got[1].replace("first", "second")
    assert got[3] == "line third" and got[4] == "line fourth"
    assert got[5] == got[6] == "a story that two pages have"
    assert got[7] == got[8] == got[9] == "read this next on every page"


def test_html_pairs_pages_of_one_path(spark):
    """Against brute force: of all addresses of the host in order, the neighbour that begins alike for longest."""
    rng = random.Random(5)
    lines = [f"menu {i}" for i in range(6)]
    pages = []
    for i in range(60):
        url = f"http://H{i % 2}/" + rng.choice([f"index.php?id={i}", f"index.php?id={i}#top", f"a/{i}", f"a/b/{i}?x=1", "index.php"])
        own = [line for line in lines if rng.random() < 0.8] + [f"story {i} {j}" for j in range(rng.randrange(3))]
        pages.append((i, url, "".join(f"<p>{line}</p>" for line in own)))
    pages += [(60, "http://h0/index.php?copy", pages[0][2]), (61, "http://h0/index.php?id=1", ""), (62, "http://h0/index.php?id=1", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    split = lambda url: re.match(r"http://([^/]*)([^?#]*)\??([^#]*)", url).groups()
    content = {i: tuple(re.findall("<p>(.*?)</p>", html or "")) for i, _, html in pages}
    first = {}
    for i, url, _ in pages:
        if content[i]:
            host, path, query = split(url)
            key = (host.lower(), content[i])
            first[key] = min(first.get(key, (path, query)), (path, query))
    for i, url, _ in pages:
        host = split(url)[0].lower()
        if not content[i]:
            assert got[i] == ""
            continue
        order = sorted((address, own) for (of, own), address in first.items() if of == host)
        here = (first[host, content[i]], content[i])
        if sum(address == here[0] for address, _ in order) > 1 or len(order) == 1:
            continue
        at = [address for address, _ in order].index(here[0])

        def alike(j):
            flat = ["\x01".join(filter(None, a)) for a in (here[0], order[j][0])]
            steps = [re.split("[/\x01]", a) for a in flat]
            equal = next((k for k, (x, y) in enumerate(zip(*steps)) if x != y), min(map(len, steps)))
            return equal, len(os.path.commonprefix(flat))

        beside = [j for j in (at + 1, at - 1) if 0 <= j < len(order)]
        other = order[max(beside, key=alike)][1]
        kept = [line for line in content[i] if line not in other]
        # Menus are in one order on all pages, so what two share is in their longest common subsequence.
        assert got[i] == " ".join(kept), (i, other)
    assert got[60] == got[0]


def test_common_lines():
    rng = random.Random(8)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(found) == table[-1][-1] and found == sorted(set(found)) and all(a[i] in rest for i in found)


def test_nearest(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    units = {i: v / np.linalg.norm(v) for i, v in rows.items()}
    settings = dict(pivots=125, share=0.3, least=8, shard_rows=300, block_queries=4)
    got, hits, total = {}, 0, 0
    for row in nearest.nearest(table, **settings).collect():
        assert row["score"] == pytest.approx(units[row["query_id"]] @ units[row["vec_id"]], abs=1e-12)
        got.setdefault(row["query_id"], {})[row["rank"]] = row["vec_id"]
    for i in (i for i in rows if i % 50 == 0):
        want = sorted((j for j in rows if j != i), key=lambda j: (-(units[i] @ units[j]), j))[:5]
        hits, total = hits + len(set(want) & set(got[i].values())), total + 5
    assert hits >= 0.9 * total
    odd = spark.createDataFrame(
        [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1),
         (6, [float("nan"), 1.0], 1), (None, [1.0, 0.0], 1), (50, [0.0, 1.0, 0.0], 1)], "vec_id long, embedding array<double>, id int")
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest.nearest(odd).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert nearest.nearest(odd.where("vec_id > 99")).count() == 0


def test_chat_round_trip(spark):
    tricky = ["<|im_end|>\n", "<\\|im_sep|>", "<\\\\|", "\\<|", "", "a\nb", "$1\\1", None]
    rows = [(1, i, "assistant" if i % 3 else "user", t, "x") for i, t in enumerate(tricky)]
    rows += [(2, None, None, "n", "x"), (2, 0, "assi\nstant", "r", "x"), (None, 1, "assistant", "z", "x"), (3, 1, "b", "t", "x"), (3, 1, "b", "t", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    back = {row["conv_id"]: row for row in chat.read_chats(chat.format_chats(df)).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r, t or "") for _, _, r, t, _ in rows[:8]]
    assert back[1]["loss_texts"] == [t or "" for i, t in enumerate(tricky) if i % 3]
    assert [tuple(t) for t in back[2]["turns"]] == [("", "n"), ("assi\nstant", "r")] and len(back[3]["turns"]) == 2
    assert back[None]["loss_texts"] == ["z"] and chat.format_chats(df.where("turn > 99")).count() == 0


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(6)
    for seats in (0, 1, 7, 100):
        votes = [rng.choice((0, 1, 5, 40, 1000)) for _ in range(9)]
        votes[0] = 3
        df = spark.createDataFrame([(i, float(v), seats, 1) for i, v in enumerate(votes)], "i long, v double, s long, g int")
        got = {row["i"]: row["quota"] for row in mixing.apportion(df, ["i"], ["g"], "v", "s").collect()}
        best = sorted((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(seats))[:seats]
        assert got == {i: sum(j == i for _, j in best) for i in range(len(votes))}


def test_mix(spark):
    rows = [(i, prose(i, i % 50), "abcd"[i % 4] if i % 5 else "e") for i in range(10, 410)] + ODD
    got = mixing.mix(docs(spark, rows), shard_rows=30, block_words=4).collect()
    sizes = {"" if s is None else s: 0 for _, _, s in rows}
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    source_of = {i: s for i, _, s in rows}
    taken, target = dict.fromkeys(sizes, 0), {}
    for r in got:
        if r["doc_id"] is not None:
            taken[source_of[r["doc_id"]] or ""] += r["taken"]
            target[source_of[r["doc_id"]] or ""] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 4 * 6 for s in target)
    mixed = mixing.mixed_rows(docs(spark, rows), columns=["doc_id", "text"], shard_rows=30, block_words=4).collect()
    assert sum(len(WORD.findall(r["text"])) for r in mixed) == sum(r["taken"] for r in got)
    assert mixing.mix(docs(spark, [])).count() == 0 and {r["taken"] for r in mixing.mix(docs(spark, ODD[:3])).collect()} == {0}


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs_table = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.identify_languages(spark, docs_table, SF)
    assert kept.columns == docs_table.columns and kept.count() >= 0.95 * docs_table.count()
    alone = corpus_pipeline.drop_near_duplicates(spark, docs_table, SF)
    want = brute_components({r["doc_id"]: r["text"] for r in docs_table.collect()})
    assert {r["doc_id"] for r in alone.collect()} == {i for i, (_, root) in want.items() if i == root}


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    small, other, shared, alone, near = (prose(f"k{i}", 60) for i in range(5))
    rows = [(1, small), (2, small), (2, other), (None, alone), (None, shared), (None, shared), (3, near), (3, near), (4, ""), (4, ""), (None, None)]
    rows += [(5, prose("k5", 40)), (5, prose("k5", 40) + " more"), (6, prose("k5", 40))]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert kept.columns == corpus_pipeline.COLUMNS
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    of_five = [row for row in got if row[0] == 5]
    assert len(of_five) == 1 and of_five[0] in rows
    want = [(1, small), (2, other), (None, alone), (None, shared), (3, near), (4, ""), (4, ""), (None, None)]
    assert [row for row in got if row[0] != 5] == sorted(want, key=repr)
    assert corpus_pipeline.drop_near_duplicates(spark, df.where("doc_id > 99"), SF).count() == 0


def test_jaccard_join_without_identifiers_looks_up_each_text_once(spark):
    """2,000 rows of null identifiers: the join that fetches the texts of pairs gives no more rows than it has texts."""
    from tidewright.llm.jaccard import _members_of, _sets, summaries

    rows = _sets(docs(spark, [(None, prose(i // 2, 30) + (" more" if i % 2 else ""), "s") for i in range(2_000)]), "doc_id", "text")
    known = summaries(rows, 5)
    sets = known.groupBy("name").agg(F.min("digest").alias("digest"))
    pairs = sets.select(F.col("name").alias("a"), F.col("name").alias("b"))
    assert rows.join(sets, "digest").count() == 2_000
    assert _members_of(pairs, rows, sets, 5).count() == sets.count() == 2_000


def test_equal_vectors_have_equal_cosines_in_blocks_of_any_size(spark):
    rng = np.random.default_rng(11)
    same = rng.normal(size=(8, 64))
    for n in (3, 17, 64, 301):
        rows = np.concatenate([np.repeat(same, 8, axis=0), rng.normal(size=(n, 64))])
        order = rng.permutation(len(rows))
        # Copies get the smallest identifiers, in no order of place.
        ids = np.arange(len(rows))
        shuffled, own = rows[order], ids[order]
        place = np.argsort(own)
        found = nearest.search_shard(
            same + 0.01, np.arange(-8, 0), shuffled[place], own[place], nearest._units(rng.normal(size=(16, 64))),
            length=8, share=1.0, least=1, k=5)
        for query in range(8):
            assert [row for q, row, _ in found if q == query - 8] == [8 * query + i for i in range(5)]
            assert len({score for q, _, score in found if q == query - 8}) == 1
