"""The registered query of each operator, over its whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import conversations, decontaminate, exactdup, language, licenses, manifest, mixing, neardup, quality, rollups, simhash, tokenfiles, urls
from millrace.llm.registry import LLM_QUERIES, query
from millrace.session import shared_dir
from millrace.tables import table


@query()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.fit(quality.labelled_sample(docs, labels), quality.label_counts(labels)))


# The same with SQL's own grouping by whole text.
EXACT_SQL = """
WITH plain AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), grouped AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM plain GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM plain JOIN grouped USING (t)
"""


@query(EXACT_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


@query()
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled URLs are the pages of labelled documents: a page's path names its document."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.regexp_extract(urls.parts(F.col("url"))[1], "/([0-9]{1,18})", 1)
    shown = pages.select("url", number.try_cast("long").alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("blocked")
    return urls.judge(pages, labelled=shown.join(labels, "doc_id").select("url", bad))


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "tokens")
    written = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, special=True)
    return tokenfiles.read_all(spark, folder, written)


# What the batches below leave: all documents but those of poor quality, with the last label of toxic ones as source.
ROLLUP_SQL = r"""
WITH poor AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND toxic = 1),
kept AS (
  SELECT CASE WHEN t.doc_id IS NOT NULL THEN 'toxic' ELSE d.source END AS source, d.lang, coalesce(d.text, '') AS t
  FROM documents d LEFT JOIN toxic t ON d.doc_id = t.doc_id
  WHERE d.doc_id NOT IN (SELECT doc_id FROM poor WHERE doc_id IS NOT NULL)
), counted AS (
  SELECT source, lang, 'words-1' AS tokenizer,
    len(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'pieces-1',
    len(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{1,4}|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM counted GROUP BY ALL
"""


@query(ROLLUP_SQL)
def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, take the poor ones away, move the toxic ones to a source of their own; each batch is sent twice."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rollup = rollups.TokenRollup(spark, shared_dir(spark, "rollup"))
    poor = labels.filter("quality = 0").select("doc_id")
    toxic = labels.filter("quality = 1 AND toxic = 1").select("doc_id").distinct()
    moved = docs.withColumn("source", F.lit("toxic"))
    for _ in range(2):
        rollup.commit("load", insert=docs)
        rollup.commit("poor", delete=poor)
        rollup.commit("toxic", revise=moved, revised=toxic)
    return rollup.totals()


@query()
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), mixing.domain_of(table(spark, sf_dir, "labels"))).drop("at")


@query()
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(*language.learning_sample(docs)))


@query()
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, linked=3)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults: by the CRC-32 of its place a turn is dropped, emptied, unpunctuated, repeated or given to the user."""
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate, text, role = F.crc32(place.cast("binary")) % 20, F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).when(fate != 0, F.array(F.lit(1))).otherwise(F.array())
    return turns.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of which no turn is left after the damage are repaired at no cost."""
    turns = table(spark, sf_dir, "conversations")
    repair = conversations.Repair(damaged(turns))
    digests = repair.text_digests().select(F.col("conv").alias("of"), "digest")
    report = repair.report.join(digests, F.col("conv").eqNullSafe(F.col("of")))
    every = turns.select("conv_id").distinct()
    told = every.join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    repaired = F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return told.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), repaired)


# Levels are made by a recursive query, the siblings of a node by windows over its run, and a proof by climbing from its leaf.
MANIFEST_SQL = """
WITH RECURSIVE
plain AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    coalesce(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
      list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(crc, byte)),
      4294967295), 0) AS crc
  FROM documents
), told AS (
  SELECT *, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
  FROM plain
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 5 = 0
      THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS altered
  FROM told
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), nodes AS (
  SELECT source, 0 AS level, n, rank, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, (n + 15) // 16, rank // 16, sha256(string_agg(digest, '' ORDER BY rank))
  FROM nodes WHERE n > 1 GROUP BY source, level, n, rank // 16
), subroots AS (
  SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS groups
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, groups AS n, place AS rank, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, (n + 15) // 16, rank // 16, sha256(string_agg(digest, '' ORDER BY rank)) FROM tops WHERE n > 1 GROUP BY level, n, rank // 16
), below AS (
  SELECT source, level, rank, coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW r AS (PARTITION BY source, level, rank // 16 ORDER BY rank)
), above AS (
  SELECT level, rank, coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tops WHERE n > 1 WINDOW r AS (PARTITION BY level, rank // 16 ORDER BY rank)
), climbed AS (
  SELECT source, rank AS leaf_rank, doc_id, leaf, 0 AS level, rank, n, coalesce(altered, leaf) AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.source, leaf_rank, doc_id, leaf, c.level + 1, c.rank // 16, (c.n + 15) // 16, sha256(before || folded || after), proof || before || after
  FROM climbed c JOIN below b ON c.source IS NOT DISTINCT FROM b.source AND c.level = b.level AND c.rank = b.rank WHERE c.n > 1
), topped AS (
  SELECT c.source, leaf_rank, doc_id, leaf, subroot, 0 AS level, place AS rank, groups AS n, folded, proof
  FROM climbed c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source WHERE c.n = 1
  UNION ALL
  SELECT t.source, leaf_rank, doc_id, leaf, subroot, t.level + 1, t.rank // 16, (t.n + 15) // 16, sha256(before || folded || after), proof || before || after
  FROM topped t JOIN above a ON t.level = a.level AND t.rank = a.rank WHERE t.n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM topped, (SELECT digest AS root FROM tops WHERE n = 1) WHERE n = 1
"""


@query(MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents. Where 5 divides the CRC-32 of the id, a text with A-Z lower-cased is held against its proof."""
    docs = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, manifest.leaf_digest(*columns, lowered))
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    built = manifest.Manifest(manifest.leaves_of(docs, "source", "doc_id", names, altered=altered))
    folded = manifest.fold(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root")
    proofs = built.proofs(built.leaves).select(
        F.col("key").alias("doc_id"), manifest.hex_text(F.col("leaf")).alias("leaf"), manifest.hex_text(F.col("root")).alias("subroot"),
        F.lit(built.root).alias("root"), manifest.siblings_digest(F.col("path")).alias("proof_sha256"), folded,
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


__all__ = ["LLM_QUERIES"]
