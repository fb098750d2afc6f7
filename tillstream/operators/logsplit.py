"""Behaviour-log DWD operators: P-1 parse + dirty side output, D-1 is_new
correction, O-15 five-way split (err / start / page / display / action).

Batch forms are pure DataFrame -> DataFrame functions; the stream twins in
:mod:`tillstream.streaming.twins` run the same parse on a text stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import ts_to_date
from ..sources.logs import LOG_T
from .state import first_per_group

CORRUPT = "_corrupt_record"
DAY_MS = 86_400_000


def parse_log(text: DataFrame, schema: T.StructType = LOG_T, value_col: str = "value", fail_fast: bool = False) -> DataFrame:
    """P-1: parse JSON lines PERMISSIVE-ly; unparsable lines keep their text in ``_corrupt_record``.
    P-3: with ``fail_fast`` the first unparsable line fails the query."""
    if fail_fast:
        parsed = F.from_json(F.col(value_col), schema, {"mode": "FAILFAST"})
        return text.select(parsed.alias("j")).select("j.*", F.lit(None).cast("string").alias(CORRUPT))
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value_col), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # a generated row: filters and fields read the parsed record, where Catalyst would copy the parse into each of them
    return text.select(F.explode(F.array(parsed)).alias("j")).select("j.*")


def clean_rows(parsed: DataFrame) -> DataFrame:
    """Main output of P-1: well-formed records."""
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dirty_rows(parsed: DataFrame) -> DataFrame:
    """Side output of P-1: the raw text of every malformed record."""
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("dirty"))


# A device's rows are spread over so many join groups.
SALTS = 16


def fix_is_new(log: DataFrame) -> DataFrame:
    """D-1: correct ``common.is_new`` per device (mid).

    State per mid is written once, by the mid's first record in (ts, event_id) order: its date when it
    claims to be new, else the day before. Any later record that claims to be new on a different date than
    that state is set to '0' (N-7). Batch form: the first record per mid (top-1 per key, reduced map-side
    before the shuffle) is repeated once per salt and joined back on (mid, salt), so a device holding a third
    of all rows is spread over ``SALTS`` groups. A row without a device has no state: it is kept
    unchanged (N-19). The reference's 10 s processing-time TTL has no batch meaning and is not applied.
    """
    heads = log.select(F.col("common.mid").alias("_mid"), F.col("common.is_new").alias("_is_new"), F.col("ts").alias("_ts"), F.col("event_id").alias("_id"))
    first = first_per_group(heads.where("_mid is not null"), ["_mid"], ["_ts", "_id"]).select(
        "_mid",
        F.when(F.col("_is_new") == "1", ts_to_date(F.col("_ts")))
        .otherwise(ts_to_date(F.col("_ts") - DAY_MS))
        .alias("_first_state"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_slot"),
    )
    salted = log.withColumn("_salt", F.pmod(F.xxhash64("event_id", "ts"), F.lit(SALTS)).cast("int"))
    j = salted.join(first, (salted["common.mid"] == first["_mid"]) & (salted["_salt"] == first["_slot"]), "left")
    fixed = (
        F.when((F.col("common.is_new") == "1") & (F.col("_first_state") != ts_to_date(F.col("ts"))), F.lit("0"))
        .otherwise(F.col("common.is_new"))
    )
    return j.withColumn("common", F.col("common").withField("is_new", fixed)).drop("_mid", "_first_state", "_salt", "_slot")


# --- O-15 five-way split -------------------------------------------------------------------------


def split_err(log: DataFrame) -> DataFrame:
    """err rows are emitted whole (with displays/actions) (N-15)."""
    return log.filter(F.col("err").isNotNull())


def split_start(log: DataFrame) -> DataFrame:
    """start rows, with ``err`` removed."""
    return log.filter(F.col("start").isNotNull()).drop("err")


def split_page(log: DataFrame) -> DataFrame:
    """page rows: no start; err removed; non-empty displays/actions removed (empty arrays stay)."""
    rows = log.filter(F.col("start").isNull())
    return rows.select(
        "common",
        "page",
        F.when(F.size("displays") > 0, F.lit(None)).otherwise(F.col("displays")).alias("displays"),
        F.when(F.size("actions") > 0, F.lit(None)).otherwise(F.col("actions")).alias("actions"),
        "ts",
        "event_id",
    )


def split_display(log: DataFrame) -> DataFrame:
    """one row per display of a page row: common, page, display, ts."""
    rows = log.filter(F.col("start").isNull())
    return rows.select("common", "page", F.explode("displays").alias("display"), "ts")


def split_action(log: DataFrame) -> DataFrame:
    """one row per action of a page row: common, page, action (no ts)."""
    rows = log.filter(F.col("start").isNull())
    return rows.select("common", "page", F.explode("actions").alias("action"))


def five_way_split(log: DataFrame) -> dict[str, DataFrame]:
    return {
        "err": split_err(log),
        "start": split_start(log),
        "page": split_page(log),
        "display": split_display(log),
        "action": split_action(log),
    }
