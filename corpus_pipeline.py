"""Corpus pipeline: quality, line dedup, near-duplicates, mixing and tokens, each stage over what the one before kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import bpe, line_dedup, mixing, quality, simhash
from tillstream.llm.common import materialize, read, session

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on this stage's labelled input, scores under 0.3."""
    session(spark)
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later repeats of runs of lines out of the texts."""
    session(spark)
    return line_dedup.stage(docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    session(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replicates documents to the target weights of their sources and shuffles them."""
    session(spark)
    return mixing.stage(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, packed as little-endian unsigned 32-bit integers, and a round-trip mark."""
    session(spark)
    made = bpe.encode_and_decode(docs, public_tokenizers.path(TOKENIZER), extra=["source"])
    same = F.coalesce(F.col("text"), F.lit("")) == F.col("decoded")
    return made.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality", quality_stage),
    ("lines", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: The classifier, XXH64 fingerprints and byte-pair merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back."""
    docs = read(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
