"""The registered queries of the operators: ``QUERIES`` maps a key to ``(spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to its whole table and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chunk_dedup, embed_dedup, line_dedup, mixing, pieces, quality, secret_scan, sharding, simhash, spelling, topk, turns
from .common import read, session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text by the byte network trained outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text, base kinds and owner-specific tokens."""
    found = secret_scan.secrets(read(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == secret_scan.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["repositories"].cast("string"), s["owners"].cast("string")))).alias("span_counts"),
        "n_live",
        "n_copied",
    )


@query
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the chunks that an earlier document holds."""
    return chunk_dedup.dedup(read(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the later repeats of runs of lines and of long lines deleted."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "text", "n_lines", line_dedup.removed(F.col("__runs")).alias("n_removed"))


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and what they decode to, as digests."""
    made = bpe.encode_and_decode(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return made.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products for every fiftieth vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the smallest id of its group."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus replicated to the target weights and shuffled: one row per copy."""
    out = mixing.replicate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "text", F.col("__copy").alias("copy"), F.col("__order").alias("order_key"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, with digests of what was moved."""
    out = sharding.shard(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("__shard").cast("int").alias("shard"),
        F.col("__slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its near words counted, its more frequent form and its root."""
    return spelling.variants(spelling.words(read(spark, sf_dir, "documents")))


@query
def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, their source spans and what they decode to, as digests."""
    made = pieces.encode_and_decode(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat(joined("begins"), F.lit(";"), joined("ends")).cast("binary"), 256).alias("spans_sha256"),
    )


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    return turns.repair(read(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
