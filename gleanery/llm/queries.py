"""Queries opN_<name>, each over its whole table, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import decontaminate, exact_fingerprint, html_main, importance, language_id, packing, prefix_tree, simhash_dedup, token_rollup, warc
from gleanery.llm.common import checkpoint, shared_path, table

BPE_WORDS, BPE_BYTES = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
CONTROL = "<|im_end|><|im_start|>assistant ok"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slot_heavy=True)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents after a history of batches over the whole table, each committed twice: inserted with words
    for tokens, all revised to the tokenizer's counts (another version, so other keys), all inserted once more and,
    after a compaction, those deleted again."""
    rollup = token_rollup.Rollup(spark, shared_path(spark, f"rollup-{uuid.uuid4().hex}"))
    docs = table(spark, sf_dir, "documents")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")).cast("long")
    draft = docs.select("doc_id", "source", "lang", F.lit("words").alias("tokenizer_version"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), words.alias("n_tokens"))
    counts = checkpoint(token_rollup.count_tokens(docs, public_tokenizers.path(BPE_WORDS), "word_bpe_49k"))
    history = [("draft", token_rollup.inserts(draft)), ("revised", token_rollup.revisions(draft, counts)), ("again", token_rollup.inserts(counts)), ("taken back", token_rollup.deletes(counts))]
    for batch, changes in history:
        if batch == "taken back":
            rollup.compact()
        for _ in range(2):
            rollup.commit(batch, changes)
    return rollup.totals()


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    every = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(more)
    return prefix_tree.formatted_digests(every, public_tokenizers.path(BPE_BYTES))


def op6_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_WORDS), payload=packing.crc32, payload_type="long")
    return out.withColumnRenamed("payload", "ids_crc32")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_decontaminate, op2_simhash, op3_token_rollup, op4_fingerprints, op5_chat_tree, op6_resample, op7_main_text, op8_pack, op9_language, op10_warc)}


def oracle_sql() -> dict[str, str]:
    escaped = lambda x: f"regexp_replace({x}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    return {
        "op5_chat_tree": f"""
            WITH c AS (
              SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}')
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                   CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
                   sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
                   CAST(sum(24 + length({escaped("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
            FROM c GROUP BY conv_id""",
        "op10_warc": """
            WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
                 q AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
            SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN top <> page_id THEN top END AS refers_to FROM q""",
    }
