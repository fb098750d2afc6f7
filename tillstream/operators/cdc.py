"""CDC envelope operators: validity filter, before/after pick, upsert final
state, column-wise merge, config-driven routing and column pruning
(P-4, P-5, P-5a, O-5, O-6a-c, O-7, O-9, O-10, O-12, O-13, O-13a, O-13b, O-14).

The routing config is a change log itself; it is folded to its current state
(a handful of rows, one per source table) and broadcast to the data stream.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maps import keep_keys
from ..sources.tables import small
from .state import last_per_group

VALID_OPS = ("c", "u", "d", "r")


# ---- P-4 / P-5 / P-5a ---------------------------------------------------------------------------


def valid_changes(topic: DataFrame, db: str) -> DataFrame:
    """P-4: database matches, op is c/u/d/r, ``after`` present and not an empty object."""
    after_json = F.to_json(F.col("after"))
    return topic.filter(
        (F.col("source")["db"] == db)
        & F.col("op").isin(*VALID_OPS)
        & F.col("after").isNotNull()
        & (F.length(after_json) > 2)
    )


def before_or_after(topic: DataFrame) -> Column:
    """P-5: the row image that describes the change: ``before`` for deletes, else ``after``."""
    return F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))


def after_else_before(topic: DataFrame) -> Column:
    """P-5a: ``after`` when non-empty, else ``before``, merged with ``op`` and ``tm_ms``."""
    img = F.when(F.coalesce(F.size(F.col("after")), F.lit(0)) > 0, F.col("after")).otherwise(F.col("before"))
    meta = F.create_map(F.lit("op"), F.col("op"), F.lit("tm_ms"), F.col("ts_ms").cast("string"))
    return F.map_concat(img, meta)


# ---- O-5 ----------------------------------------------------------------------------------------


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def rename_camel(df: DataFrame) -> DataFrame:
    """O-5: underscore column names -> camelCase (the JDBC bean mapping)."""
    return df.toDF(*[camel(c) for c in df.columns])


# ---- O-6a / O-6b / O-6c -------------------------------------------------------------------------


def point_lookup(dim: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    """O-6a: rows of ``dim`` for every requested row key -- a batch of point reads is a semi join."""
    return dim.join(keys.select(F.col(key).alias("_k")).distinct(), dim[key] == F.col("_k"), "left_semi")


def scan_limit(dim: DataFrame, n: int, key: str = "row_key") -> DataFrame:
    """O-6b: the first ``n`` rows in row-key (string) order (Spark plans TakeOrderedAndProject)."""
    return dim.orderBy(F.col(key).cast("string")).limit(n)


def row_count(dim: DataFrame) -> DataFrame:
    """O-6c: one-row count."""
    return dim.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))


# ---- O-7 ----------------------------------------------------------------------------------------


def upsert_final(changes: DataFrame, key: str, order: list, delete_col: str = "op", delete_value: str = "d") -> DataFrame:
    """O-7: final state of an upsert sink -- the last record per key wins; a delete leaves a tombstone
    (the key disappears)."""
    last = last_per_group(changes, [key], order)
    return last.filter(F.coalesce(F.col(delete_col), F.lit("")) != delete_value)


# ---- O-10 ---------------------------------------------------------------------------------------


def columnwise_merge(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """O-10: wide-column merge. Per key, a delete erases the row; every other change puts only its
    non-empty columns, so an empty value never overwrites an older one (N-1).

    ``changes`` has ``op``, ``before``/``after`` maps, the ``key`` column and ``order`` columns.
    Result: one row per live key with ``cells`` = MAP<column, value>.

    Plan, one scan: every change explodes into (key, column, value) cells, a delete into one mark; the last
    cell per (key, column) is a top-1, reduced inside each map task before the shuffle, so a hot key ships
    one row per column and task; of what is left (at most the column count per key) the cells after the
    key's last delete fold into one map.
    """
    last = last_cells(changes, key, order).withColumn("_pos", F.struct(*[F.col(c) for c in order]))
    gone = F.max(F.when(F.col("col").isNull(), F.col("_pos"))).over(Window.partitionBy(key))
    alive = last.withColumn("_gone", gone).where("col is not null and (_gone is null or _pos > _gone)")
    return alive.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("col", "val"))).alias("cells"))


def last_cells(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, order..., col, val): the last non-empty value of each cell, and each key's last delete as ``col`` null."""
    cells = F.when(F.col("op") == "d", F.array(F.struct(F.lit(None).cast("string").alias("col"), F.lit("d").alias("val")))).otherwise(
        F.transform(F.map_entries("after"), lambda e: F.struct(e["key"].alias("col"), e["value"].alias("val")))
    )
    each = changes.select(key, *order, F.explode(cells).alias("_c")).select(key, *order, "_c.col", "_c.val").where("val is not null and val <> ''")
    return last_per_group(each, [key, "col"], order)


# ---- O-12 / O-13 / O-13a / O-13b / O-14 ---------------------------------------------------------


def prune_columns(payload: Column, sink_columns: Column) -> Column:
    """O-12: keep only payload keys listed in the CSV ``sink_columns``."""
    return keep_keys(payload, sink_columns)


def fold_config(changes: DataFrame, key: str = "source_table", order: str = "seq") -> DataFrame:
    """O-13a: config change log -> current config: last change per key; deletes remove the key."""
    return upsert_final(changes, key, [order])


def config_actions(changes: DataFrame) -> DataFrame:
    """O-13b: target lifecycle per config change: d -> drop, r/c -> create, u -> drop then create."""
    acts = (
        F.when(F.col("op") == "d", F.array(F.lit("drop")))
        .when(F.col("op").isin("r", "c"), F.array(F.lit("create")))
        .when(F.col("op") == "u", F.array(F.lit("drop"), F.lit("create")))
    )
    return changes.select("seq", "sink_table", "sink_family", F.posexplode(acts).alias("step", "action"))


def route_dim(data: DataFrame, config: DataFrame) -> DataFrame:
    """O-13: valid change rows ⋈ current config on source table (broadcast if it has few rows, as
    counted: one row per configured table). Emits sink table, row key, op and the pruned payload."""
    cfg = small(config.select("source_table", "sink_table", "sink_columns", "sink_row_key"))
    j = data.join(cfg, data["source"]["table"] == cfg["source_table"], "inner")
    payload = prune_columns(F.col("after"), F.col("sink_columns"))
    return j.select(
        "sink_table",
        F.col("after")[F.col("sink_row_key")].alias("row_key"),
        "op",
        payload.alias("data"),
        "ts_ms",
    )


def route_dwd(data: DataFrame, config: DataFrame) -> DataFrame:
    """O-14: change rows ⋈ config on (table, op); the row image is after-else-before; adds ts_ms."""
    cfg = small(config)
    j = data.join(
        cfg, (data["source"]["table"] == cfg["source_table"]) & (data["op"] == cfg["source_type"]), "inner"
    )
    img = after_else_before(data)
    return j.select("sink_table", prune_columns(img, F.col("sink_columns")).alias("data"), "ts_ms")


def dynamic_sink_records(routed: DataFrame, key_field: str = "id") -> DataFrame:
    """O-9: sink records whose topic comes from each row's config (``topic``, ``key``, ``value``)."""
    return routed.select(
        F.col("sink_table").alias("topic"),
        F.col("data")[key_field].alias("key"),
        F.to_json(F.col("data")).alias("value"),
    )


def write_dynamic(records: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    """O-9 writer: one folder per topic (``partitionBy``), so each row lands in its configured sink."""
    records.write.mode(mode).partitionBy("topic").format(fmt).save(path)


# ---- O-11a --------------------------------------------------------------------------------------


def snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def bean_to_snake_json(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """O-11a: a bean row -> one snake_case JSON string; ``drop`` = non-serialised fields; nulls omitted."""
    cols = [F.col(c).alias(snake(c)) for c in df.columns if c not in drop]
    return df.select(F.to_json(F.struct(*cols)).alias("json"))

