"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, chat, decontaminate, filter_audit, fim, langid, mixing, near_texts, quality, repeats, sharding, token_count, vectors
from stratum.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents as byte-level BPE ids and back."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "token_ids")
    return bpe.decode(encoded, ranks).select("doc_id", *bpe.digests(encoded))


@query
def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text of documents by the word_bpe_49k tokenizer."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"),
    )


@query
def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal size."""
    rows = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


@query
def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 5, 2, 1 under a time-varying curriculum;
    rows come in order of the first training position."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda n, p: n + p["taken"])
    return (
        mixing.allot(docs, mixing.curriculum)
        .select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.get("passes.position", F.lit(0)).alias("position"))
        .orderBy("position", "doc_id")
    )


ORACLES["op7_curriculum_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         CASE kind WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS tilt FROM s
), o AS (  -- by size over weight: a source is full exactly if it is with all before it full
  SELECT *, (SELECT sum(source_size) FROM w)
            - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w WINDOW o AS (ORDER BY source_size / weight, source)
), f AS (
  SELECT *, rest::DOUBLE * weight / weights >= 3 * source_size AS is_full FROM o
), c AS (
  SELECT coalesce(sum(source_size) FILTER (is_full), 0) AS held, sum(weight) FILTER (NOT is_full) AS open FROM f
), t AS (
  SELECT f.source, source_size, weight, tilt,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE
              ELSE ((SELECT sum(source_size) FROM w) - 3 * held)::DOUBLE * weight / open END AS target
  FROM f, c
), r AS (
  SELECT doc_id, size, source_size, target, weight * (1 - tilt) AS w0, weight * (1 + tilt) AS w1,
         (sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, least(size, greatest(0, floor(target)::BIGINT - start)) AS p0,
         least(size, greatest(0, floor(target)::BIGINT - start - source_size)) AS p1,
         least(size, greatest(0, floor(target)::BIGINT - start - 2 * source_size)) AS p2
  FROM r
), q AS (
  SELECT *, ((start + p0) / target) * ((w0 + w1) / 2) AS need FROM p
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (p0 + p1 + p2)::BIGINT AS taken,
       CASE WHEN p0 > 0 THEN least(2 * need / (sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * need, 0.0)) + w0), 1.0) END AS position
FROM q
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of documents, learned from the labels of the
    documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(langid.held_out(), F.lit(False)))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every text of documents."""
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


ORACLES["op8_quality_cascade"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), n AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS words
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), r AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, words) AS k FROM n) WHERE k > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM r, range(8) AS o(j) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, t, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * (length(t) - length(replace(t, chr(10), '')) + 1)
            OR 10 * length(regexp_replace(t, '[^0-9]', '', 'g')) > 3 * word_chars
            OR 5 * (length(t) - length(replace(t, '!', ''))) > n_words
            OR 10 * length(regexp_replace(t, '[^\p{L}]', '', 'g')) < 6 * word_chars) AS kept
FROM b
"""


@query
def op6_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that imitates the template, formatted and
    read back."""
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    imitation = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", imitation), (-7, 1, "assistant", imitation)], "conv_id bigint, turn bigint, role string, text string"
    )
    messages = stored(chat.from_turns(rows.unionByName(extra)), "chat-messages")
    formatted = chat.format_paths(chat.reply_paths(messages), messages)
    read = formatted.select(
        F.col("tree").try_cast("bigint").alias("conv_id"),
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLES["op6_chat_trees"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS text_chars,
         length(role) + length(regexp_replace(role, '[^\\<#:\n]', '', 'g')) AS role_chars FROM c
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + role_chars + 14)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings with their links and components."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents without its repeated 400-byte strings, and how
    many of its bytes lie in repeated passages of 250 bytes (some 50 words)."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), shorter=250).drop("kept")


@query
def op5_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their class of near-duplicate texts."""
    return near_texts.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the benchmark items whose windows they hold."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op11_decontaminate"] = r"""
WITH b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), k AS (
  SELECT DISTINCT item, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS words
  FROM (SELECT item, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), p AS (
  SELECT doc_id, size, i, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS words
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM k) WHERE len(ws) >= size)
), m AS (
  SELECT doc_id, item, p.size, i FROM p JOIN k ON p.words = k.words AND p.size = k.size
), h AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS w FROM m) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from all documents, in all orders."""
    return filter_audit.audit(filter_audit.text_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), f AS (
  SELECT doc_id, part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, [a, b, c, d, e] AS bits, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l ON l.doc_id = f.doc_id GROUP BY ALL
), x AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS x
), o AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), g AS (
  SELECT part, bits, n, good, toxic, o.o, list_position([bits[i] for i in o.o], true) AS gone FROM m, o
), z AS (
  SELECT part, o, step, o[step] AS filter, coalesce(sum(n) FILTER (gone IS NULL OR gone > step), 0) AS kept,
         coalesce(sum(n) FILTER (gone = step), 0) AS removed, coalesce(sum(n) FILTER (bits[o[step]] AND gone < step), 0) AS redundant,
         coalesce(sum(n) FILTER (bits[o[step]] AND len(list_filter(bits, lambda y: y)) = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM g, (SELECT x AS step FROM x) GROUP BY part, o, step
)
SELECT part, array_to_string([substr('ABCDE', i, 1) for i in o], '') AS filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM z
"""


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed for filling in the middle, and back."""
    framed = stored(fim.frames(table(spark, sf_dir, "documents").select("doc_id", "text")), "fim-frames")
    return fim.digests(fim.transform(framed)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLES["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id::VARCHAR) AS h FROM documents
), g AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g
), s AS (
  SELECT *, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form != 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form != 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
