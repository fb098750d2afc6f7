"""Comment pipeline (P-22, J-9, O-28, O-29, O-30)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ts_to_partition
from .cdc import after_else_before
from .interval import interval_join

# The sensitive-word dictionary (FIXTURES.md: a few common tokens of ``documents``).
SENSITIVE_WORDS = ["die", "que", "und", "les", "was"]

# Whole-text tokenizer for flagging: maximal runs of letters / digits, lower-cased.
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def flatten(topic: DataFrame) -> DataFrame:
    """P-22: comment envelope -> flat row. ``nick_name`` is read from the envelope top level, where it
    never exists, so it is always null (kept for shape)."""
    a, s = F.col("after"), F.col("source")
    return topic.filter(F.col("after").isNotNull()).select(
        "ts_ms",
        s["db"].alias("db"),
        s["table"].alias("table"),
        s["server_id"].alias("server_id"),
        a["appraise"].alias("appraise"),
        a["comment_txt"].alias("comment_txt"),
        "op",
        F.lit(None).cast("string").alias("nick_name"),
        a["create_time"].try_cast("bigint").alias("create_time"),
        a["user_id"].try_cast("bigint").alias("user_id"),
        a["sku_id"].try_cast("bigint").alias("sku_id"),
        a["id"].try_cast("bigint").alias("id"),
        a["spu_id"].try_cast("bigint").alias("spu_id"),
        a["order_id"].try_cast("bigint").alias("order_id"),
        a["dic_name"].alias("dic_name"),
    )


def order_image(order_topic: DataFrame) -> DataFrame:
    """P-5a image of order changes: after-else-before map with op and tm_ms; time = ts_ms."""
    return order_topic.select(after_else_before(order_topic).alias("m"), F.col("ts_ms").alias("o_ts"))


def join_comment_order(comments: DataFrame, orders: DataFrame, fields: list[str], lower_ms: int = -60_000, upper_ms: int = 60_000) -> DataFrame:
    """J-9: comment ⋈ order on order_id = id within ±1 min; order fields added with an ``info_`` prefix."""
    o = orders.select(F.col("m")["id"].try_cast("bigint").alias("_oid"), "o_ts", *[F.col("m")[f].alias(f"info_{f}") for f in fields])
    j = interval_join(comments, o, "order_id", "_oid", "ts_ms", "o_ts", lower_ms, upper_ms)
    return j.drop("_oid", "o_ts")


#: A dictionary is held by the driver and in generated code: a file of more distinct words is refused.
DICTIONARY_WORDS = 1_000_000


def load_dictionary(spark: SparkSession, path: str, most: int = DICTIONARY_WORDS) -> list[str]:
    """O-6d: a dictionary file, one word per line: lower-cased, distinct, without blanks, sorted.

    At most ``most + 1`` words reach the driver; a file of more than ``most`` fails, no word is left out."""
    word = F.lower(F.trim("value"))
    rows = spark.read.text(path).select(word.alias("w")).where(F.col("w") != "").distinct().orderBy("w").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path} holds more than {most} distinct words")
    return [r["w"] for r in rows]


def sensitive_hits(comments: DataFrame, text: str = "comment_txt", words: list[str] | None = None) -> DataFrame:
    """O-28: per comment, how many of its tokens are in the sensitive dictionary (whole text).

    One path for any dictionary: its distinct lower-cased words are a constant hash set inside the generated
    code, tested per token of the row. No id, no explode and no shuffle, so repeated or null ids and
    repeated words change nothing. A null text has 0 hits.
    """
    known = sorted({w.lower() for w in (SENSITIVE_WORDS if words is None else words)})
    tokens = F.split(F.lower(F.col(text)), WORD_SPLIT)
    hits = F.size(F.filter(tokens, lambda t: t.isin(known))) if known else F.lit(0)
    return comments.withColumn("hits", F.coalesce(hits, F.lit(0)).cast("bigint"))


def sample_comments(comments: DataFrame, key: str = "id", one_in: int = 5) -> DataFrame:
    """O-29 as a sampling operator: the comments whose id falls in the sample (p = 1 / ``one_in``, reproducible)."""
    return comments.where(F.pmod(F.col(key), F.lit(one_in)) == 0)


def with_ds(df: DataFrame, ts: str = "ts_ms") -> DataFrame:
    """O-30: ``ds`` = yyyyMMdd of the event time."""
    return df.withColumn("ds", ts_to_partition(F.col(ts)))


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """O-30 writer: one folder per ``ds``."""
    df.write.mode(mode).partitionBy("ds").format(fmt).save(path)
