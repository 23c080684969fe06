"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, mixing, BPE encoding and decoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. Every stage works on all rows that the one before kept, and its decisions take effect; all but the last
return the columns that they were given. Stages don't rely on unique or non-null ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberline.llm import bpe, langid, lines, mixing, simhash
from emberline.llm.queries import VOCABULARY
from emberline.llm.shared import materialise, named, unused


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be read (null texts, texts without a letter) go; a missing lang is filled in,
    with ``und`` if there was no labelled row to learn from."""
    lang, score = unused(docs, "__lang", "__score")
    model = langid.learn(docs)
    told = langid.identify(docs, model, lang_col=lang, score_col=score)
    told = told.where(F.col(lang) != langid.UNKNOWN if model.labels else F.col("text").rlike(r"\p{L}"))
    return told.withColumn("lang", F.coalesce("lang", lang)).select(*named(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text."""
    left = lines.dedup_lines(docs, counts=tuple(unused(docs, "__lines", "__dropped")))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*named(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their source's target asks, none, once or twice."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of what they decode to."""
    both = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return both.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mixing_stage),
    ("bpe_encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return materialise(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")


#: Language ID, SimHash and BPE can't be said in SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None
