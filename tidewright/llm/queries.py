"""The operators on their whole tables, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewright.llm import chat, html_text, jaccard, langid, mixing, nearest, passages, pieces, prefix_trie, simhash, slots, variants, warc
from tidewright.work import new_folder

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its name, with SQL giving the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle.strip()
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_edits(table(spark, sf_dir, "documents"))


def held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the documents, by their identifiers; those without one aren't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query()
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents.where(~held_out()))
    found = langid.identify(documents, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query(r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_id
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (source_id - 1) % 3] AS DOUBLE) AS weight, 3.0 * source_size AS cap
  FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER fill, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER fill, 0)) AS level
  FROM weighed
  WINDOW fill AS (ORDER BY cap / weight, source_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT CAST(level AS DOUBLE) AS level FROM levels WHERE level <= cap / weight ORDER BY cap / weight, source_id LIMIT 1
), targets AS (
  SELECT w.*, least(final.level * w.weight, CAST(w.cap AS DOUBLE)) AS target,
         CAST(floor(sum(source_size) OVER () / 32 + 0.5) AS BIGINT) AS seats
  FROM weighed w, final
), source_quota AS (
  SELECT source_id, count(*) AS quota FROM (
    SELECT source_id, seats, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source_id) AS place
    FROM targets, unnest(generate_series(0, seats)) AS t(k)
  ) WHERE place <= seats GROUP BY source_id
), sources AS (
  SELECT t.*, coalesce(q.quota, 0) AS quota, CAST(ceil(n_rows / 20000) AS BIGINT) AS n_shards
  FROM targets t LEFT JOIN source_quota q USING (source_id)
), dealt AS (
  SELECT d.doc_id, d.size, d.digest, s.source_id, s.source_size, s.target, s.quota,
         CAST('0x' || d.digest[1:8] AS BIGINT) % s.n_shards AS shard
  FROM docs d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), shards AS (
  SELECT source_id, shard, CAST(sum(size) AS BIGINT) AS shard_size, any_value(quota) AS seats
  FROM dealt GROUP BY source_id, shard
), shard_quota AS (
  SELECT source_id, shard, count(*) AS quota FROM (
    SELECT source_id, shard, seats,
           row_number() OVER (PARTITION BY source_id ORDER BY shard_size / (2 * k + 1) DESC, shard) AS place
    FROM shards, unnest(generate_series(0, seats)) AS t(k)
  ) WHERE place <= seats GROUP BY source_id, shard
), owing AS (
  SELECT s.*, least(coalesce(q.quota, 0) * 32, shard_size * 3) AS owes
  FROM shards s LEFT JOIN shard_quota q USING (source_id, shard)
), placed AS (
  SELECT d.*, o.shard_size, o.owes,
         coalesce(sum(size) OVER (PARTITION BY d.source_id, d.shard ORDER BY digest, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM dealt d JOIN owing o USING (source_id, shard)
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN shard_size = 0 THEN 0
                 ELSE owes // shard_size * size + greatest(0, least(size, owes % shard_size - before)) END AS BIGINT) AS taken
FROM placed
""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pieces.token_counts(pieces.encode(documents, PIECE_MODEL, keep=["doc_id"]), ["doc_id"])


@query(r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), joined AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS escaped
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length(escaped) + CASE WHEN before = role THEN length('<|im_sep|>')
                ELSE length('<|im_start|>' || role || '<|im_end|>') + 2 END) AS BIGINT) AS formatted_chars
FROM joined GROUP BY conv_id
""")
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(1).select(
        F.inline(F.array(*[
            F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                     F.lit(role).alias("role"), F.lit(tricky).alias("text"))
            for turn, role in enumerate(("user", "assistant"))
        ]))
    )
    back = chat.read_chats(chat.format_chats(rows.unionByName(more)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.group_alike(table(spark, sf_dir, "documents"))


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query()
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query()
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


@query()
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = slots.shard_documents(table(spark, sf_dir, "documents"), new_folder(spark, "slots"), shards=24)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


@query(r"""
WITH bits AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS t
  FROM range(256) AS r(i)
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295] || list_transform(range(1, len(c) + 1), lambda i: ord(c[i])),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS c FROM turns), bits
), rebuilt AS (
  SELECT i.conv_id, t.pos AS place, role, text FROM ids i JOIN turns t ON t.conv_id = i.base AND t.pos < i.h
  UNION ALL
  SELECT i.conv_id, t.pos + 4, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos >= i.h
), steps AS (
  SELECT conv_id, row_number() OVER o AS depth,
         md5(string_agg(md5(len(role) || ':' || role || text), '') OVER (o ROWS UNBOUNDED PRECEDING)) AS node,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW o AS (PARTITION BY conv_id ORDER BY place)
), members AS (
  SELECT conv_id, depth, node, words FROM steps UNION ALL SELECT conv_id, 0, '', 0 FROM ids
), nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words
  FROM members GROUP BY node
), ends AS (
  SELECT m.node, sha256(string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id)) AS ends_sha256
  FROM members m JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) e USING (conv_id, depth)
  GROUP BY m.node
), parents AS (
  SELECT n.node, p.node AS parent FROM nodes n JOIN members p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM parents GROUP BY parent
), sums AS (
  SELECT a.node, sum(CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM nodes n JOIN members a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN children c ON c.node = n.node
  GROUP BY a.node
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN parents p USING (node) LEFT JOIN nodes up ON up.node = p.parent
LEFT JOIN children c ON c.node = n.node LEFT JOIN ends e ON e.node = n.node
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = prefix_trie.branched(prefix_trie.conversations(table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_nodes(rebuilt)


@query(r"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS t
  FROM range(256) AS r(i)
), runs AS (
  SELECT id, run, count(*) AS times, list_transform(range(1, length(id || ':' || run) + 1), lambda i: ord((id || ':' || run)[i])) AS points
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
  GROUP BY id, run
), hashed AS (
  SELECT run, times,
         xor(list_reduce([4294967295] || flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END)),
                         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, bits
), results AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:length(run)] ELSE run END AS word, times
  FROM hashed
), words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), without AS (
  SELECT word, n, length(word) AS l, i, word[1:i - 1] || word[i + 1:length(word)] AS rest
  FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), pairs AS (
  SELECT a.word, b.word AS near, b.n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.l = b.l AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, CASE WHEN near_n >= 2 * w.n THEN near END AS form, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS here FROM words
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.here WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.here AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON w.word = f.word JOIN formed last ON last.word = w.here AND last.form IS NULL
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
