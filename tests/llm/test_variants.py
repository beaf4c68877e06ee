"""Spelling variants against brute force, and their defined cases."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewright.llm import queries, variants

VARIANT_DOCS = "doc_id long, text string, word string, n int, near string, gram int, form string, root int"


def variant_docs(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "x", 2, "f", 3) for i, t in rows], VARIANT_DOCS)


def brute_counts(rows, least_count=3):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= least_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    near = {w: [v for v in counts if v != w and is_near(v, w)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * counts[word] else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return {w: (form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return {row[0]: tuple(row[1:]) for row in df.collect()}


def random_texts(seed, n, letters="abé"):
    """Texts of few letters, so that most words have near ones."""
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randrange(4, 9))) for _ in range(60)]
    texts = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            word = stems[min(rng.randrange(60), rng.randrange(60), rng.randrange(60))]
            if rng.random() < 0.3:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", rng.choice(letters), word[at] + rng.choice(letters)]) + word[at + 1 :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        texts.append((i, rng.choice([" ", ", ", "1", "_"]).join(words)))
    return texts


@pytest.mark.parametrize("hot_key", [0, 2, 64])
def test_all_words(spark, hot_key):
    texts = random_texts(hot_key, 400)
    counts = brute_counts(texts)
    expected = brute_variants(counts)
    assert found(variants.spelling_variants(variant_docs(spark, texts), hot_key=hot_key)) == expected
    # Words with and without forms, and ways of more than one step.
    assert {f is None for f, *_ in expected.values()} == {True, False}
    assert any(f is not None and f != root for f, root, *_ in expected.values())


@pytest.mark.parametrize("hot_key", [0, 1, 1_000])
@pytest.mark.parametrize("length", [2, 3, 5, 6, 9])
def test_near_words_of_any_length(spark, length, hot_key):
    rng = random.Random(length)
    words = {"".join(rng.choices("abç", k=max(2, length + rng.choice((-1, 0, 0, 1))))) for _ in range(120)}
    pairs = variants.near_words(spark.createDataFrame([(w,) for w in sorted(words)], "word string"), hot_key=hot_key).collect()
    assert len(pairs) == len(set(pairs))
    assert {tuple(p) for p in pairs} == {(a, b) for a in words for b in words if a != b and is_near(a, b)}


def test_hot_gram_does_not_pair_all_its_words(spark):
    """All words begin alike: few pairs meet, since the rest of the word splits the key."""
    rng = random.Random(7)
    words = sorted({"shared" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3_000)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = {tuple(p) for p in variants.near_words(df).collect()}
    masked = Counter(w[:i] + "." + w[i + 1 :] for w in words for i in range(len(w)))
    assert len(pairs) == sum(n * (n - 1) for n in masked.values())


def test_the_deleted_letter_depends_on_document_and_word(spark):
    texts = [(i, "absolutely étrange Straße ÀÉÎ") for i in range(2_000)]
    counts = {row["word"]: row["n"] for row in variants.word_counts(variant_docs(spark, texts)).collect()}
    assert counts == brute_counts(texts) and len(counts) > 10


def test_odd_rows(spark):
    texts = [
        (None, "gallery gallery gallerie"), (None, None), (1, ""), (2, None), (3, "gallery"), (3, "gallery"), (4, "gallerie gallerie"),
        (5, "×÷multiply ×÷multiply ×÷multiply"), (6, "x" * 100_000 + " " + "y" * 99_999), (7, ("word" + "s" * 3 + " ") * 50_000), (8, "İstanbul Kelvin Ÿpsilon"),
    ]
    rows = found(variants.spelling_variants(variant_docs(spark, texts)))
    assert rows == brute_variants(brute_counts(texts)) and "×÷multiply" in rows


def test_ties_go_to_the_smaller_word_and_half_is_enough(spark):
    texts = [(0, " ".join(["planet"] * 3 + ["planek"] * 6 + ["planec"] * 6 + ["plaqes"] * 5 + ["plaqer"] * 9))]
    counts = brute_counts(texts)
    rows = found(variants.spelling_variants(variant_docs(spark, texts)))
    assert rows == brute_variants(counts)
    if counts.get("planet") == 3:
        assert rows["planet"][0] == "planec" and rows["plaqes"][0] is None


def test_no_words(spark):
    for texts in ([], [(1, "one two"), (2, None)]):
        assert variants.spelling_variants(variant_docs(spark, texts)).collect() == []


def test_long_ways_to_a_root(spark):
    pointers = spark.range(1, 50).select(F.col("id").cast("string").alias("word"), (F.col("id") - 1).cast("string").alias("form"))
    assert {tuple(r) for r in variants.roots(pointers).collect()} == {(str(i), "0") for i in range(1, 50)}


def test_query_on_all_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(queries.op13_spelling_variants(spark, sf_dir)) == brute_variants(brute_counts(texts))
