"""The queries of this subpackage: each operator over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, exact, langid, licenses, lines, media, mixing, simhash, tokens

#: The vocabulary of the tokenizer queries.
VOCABULARY = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licenses.scan(docs, licenses.learn(docs)).select("doc_id", "n_paragraphs", "n_licences", "licences", "n_unknown", "score", F.to_json("hits").alias("hits"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dups(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op3_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.inspect(media.to_pcm(media.store(documents(spark, sf_dir))))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_chats(rows.unionByName(own)))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out"))
    return langid.identify(rows, langid.learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_license_scan, op2_simhash, op3_telephony, op4_token_counts, op5_chat_format, op6_language_id, op7_line_dedup, op8_bpe, op9_exact_dedup, op10_mixing)
    return {f.__name__: f for f in made}


#: Of op5: one row for each conversation, the two rows of conversation -7 among them.
CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(11 + length(role) + length(text)
                + length(role) - length(translate(role, '\<[]', ''))
                + length(text) - length(translate(text, '\<[]', ''))) AS BIGINT) AS formatted_chars,
       FALSE AS rewritten
FROM rows GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op5_chat_format": CHAT_SQL, "op7_line_dedup": lines.SQL, "op9_exact_dedup": exact.SQL}
