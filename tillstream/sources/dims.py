"""Dimension inputs derived from the driver tables (FIXTURES.md "Mapping").

Data-derived dimensions (sku, spu, trademark, categories, provinces) grow with
the tables and are joined without a broadcast hint: Spark broadcasts them only
when its size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (and
AQE re-checks at runtime), otherwise it plans a shuffle join. The literal
dictionaries below have a fixed, proven size and are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import table

# Rating dictionary (dic_code -> dic_name).
BASE_DIC = [("1201", "好评"), ("1202", "中评"), ("1203", "差评")]

# Fixed values (FIXTURES.md): trademark names for the first four brands; other brands keep their own name.
TRADEMARK_NAMES = {"Brand#1": "TCL", "Brand#2": "苹果", "Brand#3": "欧莱雅", "Brand#4": "香奈儿"}

# Fixed values (FIXTURES.md): top-level category name by the first letter of p_type.
CATEGORY1_BY_LETTER = {"M": "数码", "S": "家居家装", "L": "厨具", "P": "手机", "E": "其他"}

# Fixed values (FIXTURES.md): top-level category -> search category ("其他" has no row).
CATEGORY_COMPARE = [("数码", "科技与数码"), ("手机", "时尚与潮流"), ("家居家装", "性价比"), ("厨具", "健康与养生")]


def base_dic(spark: SparkSession) -> DataFrame:
    """dic_code STRING, info STRUCT<dic_name STRING> (nested like the reference's ROW column)."""
    schema = T.StructType(
        [
            T.StructField("dic_code", T.StringType()),
            T.StructField("info", T.StructType([T.StructField("dic_name", T.StringType())])),
        ]
    )
    return spark.createDataFrame([(c, (n,)) for c, n in BASE_DIC], schema)


def category_compare_dic(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, c, sc) for i, (c, sc) in enumerate(CATEGORY_COMPARE)]
    return spark.createDataFrame(rows, "id INT, category_name STRING, search_category STRING")


def province(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
    )


def sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        (key - key % 4).cast("string").alias("spu_id"),
        F.col("p_retailprice").cast("decimal(16,2)").cast("string").alias("price"),
    )


def spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """spu rows are the parts whose key is a multiple of 4; their brand / type are the spu's."""
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey") % 4 == 0)
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("spu_name"),
        F.col("p_brand").alias("tm_id"),
        F.col("p_type").alias("category3_id"),
    )


def _map_or_self(col, mapping: dict):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(col)


def trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "part").select("p_brand").distinct()
    return b.select(F.col("p_brand").alias("id"), _map_or_self(F.col("p_brand"), TRADEMARK_NAMES).alias("tm_name"))


def category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").select("p_type").distinct()
    return t.select(
        F.col("p_type").alias("id"),
        F.col("p_type").alias("name"),
        F.concat(F.lit("c2-"), F.substring("p_type", 1, 1)).alias("category2_id"),
    )


def category2(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = table(spark, sf_dir, "part").select(F.substring("p_type", 1, 1).alias("l")).distinct()
    return letters.select(
        F.concat(F.lit("c2-"), F.col("l")).alias("id"),
        F.concat(F.lit("c2-"), F.col("l")).alias("name"),
        F.concat(F.lit("c1-"), F.col("l")).alias("category1_id"),
    )


def category1(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = table(spark, sf_dir, "part").select(F.substring("p_type", 1, 1).alias("l")).distinct()
    name = None
    for k, v in CATEGORY1_BY_LETTER.items():
        name = F.when(F.col("l") == k, v) if name is None else name.when(F.col("l") == k, v)
    return letters.select(F.concat(F.lit("c1-"), F.col("l")).alias("id"), name.otherwise(F.col("l")).alias("name"))


def _parents(c3) -> dict:
    """The category columns that follow from a category-3 id (``p_type``)."""
    letter = F.substring(c3, 1, 1)
    return {
        "category2_id": F.concat(F.lit("c2-"), letter),
        "category1_id": F.concat(F.lit("c1-"), letter),
        "category1_name": _map_or_self(letter, CATEGORY1_BY_LETTER),
    }


def category_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per category3 with its chain of parents, from one scan: (id, b3name, b2name, b1name)."""
    t = table(spark, sf_dir, "part").select(F.col("p_type").alias("id")).where("id is not null").distinct()
    up = _parents(F.col("id"))
    return t.select("id", F.col("id").alias("b3name"), up["category2_id"].alias("b2name"), up["category1_name"].alias("b1name"))


def sku_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sku with its spu, trademark and categories, from one scan.

    A sku and its spu are rows of the same table (the spu is the row of the sku's id rounded down to a multiple
    of 4), so the rows of one spu, four at most, are grouped and the spu's columns copied to each sku.
    Without an spu row the columns after ``spu_id`` are null.
    """
    key = F.col("p_partkey")
    spu = (key - key % 4).alias("spu")
    is_spu = key % 4 == 0
    grouped = table(spark, sf_dir, "part").groupBy(spu).agg(
        F.collect_list(F.struct(key.cast("string").alias("id"), F.col("p_name").alias("sku_name"))).alias("skus"),
        *[F.max(F.when(is_spu, F.col(c))).alias(c) for c in ("p_name", "p_brand", "p_type")],
    )
    each = grouped.select(F.explode("skus").alias("s"), "spu", "p_name", "p_brand", "p_type")
    return each.select(
        "s.id",
        "s.sku_name",
        F.col("spu").cast("string").alias("spu_id"),
        F.col("p_name").alias("spu_name"),
        F.col("p_brand").alias("trademark_id"),
        _map_or_self(F.col("p_brand"), TRADEMARK_NAMES).alias("trademark_name"),
        F.col("p_type").alias("category3_id"),
        F.col("p_type").alias("category3_name"),
        *[c.alias(n) for n, c in _parents(F.col("p_type")).items()],
        _parents(F.col("p_type"))["category2_id"].alias("category2_name"),
    )


def category3_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, name): category-3 names in sorted order, 0-based. The distinct set is tiny
    (one row per product type), so the global ordering runs on a handful of rows."""
    c3 = category3(spark, sf_dir)
    w = F.row_number().over(Window.orderBy("name")) - 1
    return c3.select(w.cast("bigint").alias("pos"), F.col("name"))


# ---- routing config (O-13, O-13a, O-14) -------------------------------------------------------

CONFIG_DIM_T = "op STRING, seq BIGINT, source_table STRING, sink_table STRING, sink_columns STRING, sink_family STRING, sink_row_key STRING"

# Fixed values (FIXTURES.md): the dim routing config change log, in arrival order.
CONFIG_DIM_CHANGES = [
    ("r", 1, "part", "dim_sku", "id,name", "info", "id"),
    ("r", 2, "nation", "dim_province", "id,name", "info", "id"),
    ("r", 3, "region", "dim_region", "id,name", "info", "id"),
    ("d", 4, "region", "dim_region", "id,name", "info", "id"),
    ("u", 5, "nation", "dim_province", "id,name,region_id", "info", "id"),
]

# DWD routing config keyed by (source_table, source_type = op).
CONFIG_DWD = [
    ("customer", "u", "dwd_user_update", "id,segment"),
    ("customer", "d", "dwd_user_delete", "id,name"),
]


def config_dim_changes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONFIG_DIM_CHANGES, CONFIG_DIM_T)


def config_dwd(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONFIG_DWD, "source_table STRING, source_type STRING, sink_table STRING, sink_columns STRING")


def dim_source_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot envelopes of the tables the dim router may see: part, nation, region (configured)
    and supplier (not configured, must be dropped)."""
    from .cdc import envelope  # local import: cdc imports this module's siblings

    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )
    n = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"),
        F.lit(0).cast("bigint").alias("ts_ms"),
    )
    r = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"), F.lit(0).cast("bigint").alias("ts_ms")
    )
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit(0).cast("bigint").alias("ts_ms")
    )
    return (
        envelope(p, "part")
        .unionByName(envelope(n, "nation"))
        .unionByName(envelope(r, "region"))
        .unionByName(envelope(s, "supplier"))
    )
