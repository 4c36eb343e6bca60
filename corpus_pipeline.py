"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of their input, whatever their names.  An empty table passes every stage and gives no piece.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleanery.llm.common import shared_path, table
from gleanery.llm.decontaminate import decontaminated
from gleanery.llm.importance import resampled
from gleanery.llm.language_id import in_known_language
from gleanery.llm.packing import crc32, pack
from gleanery.llm.simhash_dedup import deduplicated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the resampling rejects go, null and empty texts among them; without good labels all others stay."""
    return resampled(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go, and those without a letter; languages are learned from what came this far."""
    return in_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays: five words a shingle, similarity 0.8 or more.  Rows without an id
    stay; of rows that repeat one, the one with the smallest text."""
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go, with all rows of their id; null texts stay."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document (see ``packing.pack``); a null text is the end id alone."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), payload=crc32, payload_type="long").withColumnRenamed("payload", "ids_crc32")


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]

#: Learned models, connected components and tokenization: beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        at = shared_path(spark, f"pipeline-{uuid.uuid4().hex}-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
