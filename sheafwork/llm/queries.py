"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafwork.llm import (
    chat,
    decontaminate,
    divergence,
    exact,
    interaction,
    minhash,
    packing,
    passages,
    pii,
    quality,
    spherical,
    suffixes,
    tokens,
)
from sheafwork.llm.tables import table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: The conversation that the query adds: control strings inside its texts.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is a tree of one branch: a turn replies to the one before."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    numbered = rows.union(added).withColumn("message_id", place.cast("long"))
    messages = numbered.select(
        F.col("conv_id").alias("tree_id"),
        "message_id",
        (F.col("message_id") - 1).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
    laid = chat.conversations(messages)
    said = F.transform(
        chat.turns(F.col("formatted")), lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))
    )
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    read = laid.select(
        F.col("tree_id").alias("conv_id"), "n_turns", said.alias("said"), loss.alias("loss"), "formatted"
    )
    return read.select(
        "conv_id",
        F.size("said").cast("long").alias("n_turns"),
        F.sha2(F.array_join("said", ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_CHAT_SQL = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
sizes AS (
  SELECT *, length(role) + length(text) + 24 + len(regexp_extract_all(role || text, '<\\*\|'))
    + 2 * len(regexp_extract_all(role, '[%\n]')) AS chars
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality.classify(docs, labels)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, TOKENIZER, with_ids=False).drop("ids")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(pii.proposed(table(spark, sf_dir, "documents")))
    return pii.report(found, pii.fit(found))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokens.token_files(table(spark, sf_dir, "documents"), TOKENIZER)
    return tokens.file_digests(spark, folder)


def op6_spherical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.passages(docs, benchmark)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(table(spark, sf_dir, "documents"))


_EXACT_SQL = r"""
WITH normalised AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents),
judged AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY normal ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY normal) AS group_size, sha256(normal) AS text_sha256
  FROM normalised)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM judged"""


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_DIVERGENCE_SQL = rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY ALL HAVING count(*) >= {divergence.LEAST_DOCUMENTS}),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs)
  SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
own AS (SELECT lang, source, sum(n) AS size FROM counts GROUP BY ALL),
grid AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000 * (coalesce(n, 0) + {divergence.SMOOTHED})::HUGEINT)
      // (coalesce(size, 0) + {divergence.SMOOTHED} * v)::HUGEINT AS p
  FROM sources JOIN kept USING (lang) JOIN sizes USING (lang)
  LEFT JOIN counts USING (lang, source, term) LEFT JOIN own USING (lang, source)),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + {divergence.SMOOTHED})::HUGEINT)
    // (sum(sum(n)) OVER (PARTITION BY lang) + {divergence.SMOOTHED} * any_value(v))::HUGEINT AS q
  FROM counts JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
over AS (SELECT lang, source, term AS item, p - q AS value FROM grid JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every
  UNION ALL SELECT lang, source, 'term', item, value FROM over)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {divergence.TOP}"""


def op13_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return interaction.audit(docs, labels)


_INTERACTION_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
flags AS (
  SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM texts),
sums AS (
  SELECT part, fails, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
numbered AS (
  SELECT *, strpos('ABCDE', filter_order[step]) AS own,
    [x FOR x IN [1, 2, 3, 4, 5] IF strpos(filter_order, 'ABCDE'[x]) < step] AS before FROM steps),
rows_ AS (
  SELECT part, filter_order, step, own, docs, good, toxic, fails[own] AS bad,
    len([x FOR x IN before IF fails[x]]) > 0 AS gone, len([x FOR x IN fails IF x]) = 1 AS single
  FROM sums, numbered),
summed AS (
  SELECT part, filter_order, step, any_value(own) AS own,
    coalesce(sum(docs) FILTER (NOT bad AND NOT gone), 0) AS kept,
    coalesce(sum(docs) FILTER (bad AND NOT gone), 0) AS removed,
    coalesce(sum(docs) FILTER (bad AND gone), 0) AS redundant,
    coalesce(sum(docs) FILTER (bad AND single), 0) AS unique_fails,
    coalesce(sum(good) FILTER (bad AND NOT gone), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (bad AND NOT gone), 0) AS toxic_lost
  FROM rows_ GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM summed"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_chat,
        op2_quality,
        op3_packing,
        op4_pii,
        op5_token_files,
        op6_spherical,
        op7_suffixes,
        op8_decontaminate,
        op9_minhash,
        op10_passages,
        op11_exact,
        op12_divergence,
        op13_interaction,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat": _CHAT_SQL,
    "op11_exact": _EXACT_SQL,
    "op12_divergence": _DIVERGENCE_SQL,
    "op13_interaction": _INTERACTION_SQL,
}
