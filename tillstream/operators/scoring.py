"""Age-bucket label scoring (M-1 ... M-7).

Every model is a static score table ``key -> (s_18_24 ... s_50)`` applied
through one generic operator, :func:`score_join`, as a constant lookup map
(the tables are fixed and tiny: no join, no exchange). Scores are exact decimals multiplied by the
model weight and rounded HALF_UP to 3 places (F-13); results are doubles.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# Model weights.
WEIGHTS = {"device": 0.1, "search": 0.15, "pay_time": 0.1, "amount": 0.15, "tname": 0.2, "b1name": 0.3}

# Raw scores per bucket (18-24, 25-29, 30-34, 35-39, 40-49, 50+).
DEVICE_SCORES = {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
SEARCH_SCORES = {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
}
SEARCH_DEFAULT = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
PAY_TIME_SCORES = {
    "凌晨": (0.2, 0.1, 0.1, 0.1, 0.1, 0.1),
    "早晨": (0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
    "上午": (0.2, 0.2, 0.2, 0.2, 0.3, 0.4),
    "中午": (0.4, 0.4, 0.4, 0.4, 0.4, 0.3),
    "下午": (0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
    "晚上": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    "夜间": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
}
AMOUNT_SCORES = {
    "low": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1),  # total < 1000
    "mid": (0.2, 0.4, 0.6, 0.7, 0.8, 0.7),  # 1000 < total < 4000
    "high": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),  # everything else, including exactly 1000
}
BRAND_SCORES = {
    "TCL": (0.2, 0.3, 0.4, 0.5, 0.6, 0.7),
    "苹果": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "联想": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "小米": (0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
    "欧莱雅": (0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
    "香奈儿": (0.3, 0.4, 0.6, 0.8, 0.9, 0.2),
}
BRAND_DEFAULT = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
CATEGORY_YOUNG = ("数码", "手机", "电脑办公", "个护化妆", "服饰内衣")
CATEGORY_OLDER = ("家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器")
CATEGORY_SCORES = {
    **{c: (0.9, 0.8, 0.6, 0.4, 0.2, 0.1) for c in CATEGORY_YOUNG},
    **{c: (0.2, 0.4, 0.6, 0.8, 0.9, 0.7) for c in CATEGORY_OLDER},
}
CATEGORY_DEFAULT = (0.1, 0.2, 0.4, 0.5, 0.8, 0.9)


def score_join(
    spark: SparkSession,
    df: DataFrame,
    key: Column,
    scores: dict[str, tuple],
    prefix: str,
    weight: float,
    default: tuple | None = None,
    null_default: bool = False,
) -> DataFrame:
    """Add ``{prefix}_{bucket}`` columns = round(score(key) * weight, 3).

    Unknown keys get ``default`` (or null when no default); a null key gets null unless
    ``null_default`` (the search model scores a missing category as 0).

    The score table is fixed and tiny. Its weighted, HALF_UP-rounded values are computed once,
    exactly, with Python decimals and embedded as a constant-folded ``MAP<key, ARRAY<DOUBLE>>``:
    one map lookup per row and model inside the generated code, no arithmetic, no exchange,
    no join -- the same answer as a broadcast hash join against the score table.
    """
    arr = f"_{prefix}_scores"
    lookup = score_map(scores, weight)[key]
    if default is not None:
        filled = F.coalesce(lookup, _double_array(weighted_scores(default, weight)))
        lookup = filled if null_default else F.when(key.isNull(), F.lit(None)).otherwise(filled)
    with_arr = df.withColumn(arr, lookup)
    out = [F.col(arr).getItem(i).alias(f"{prefix}_{b}") for i, b in enumerate(BUCKETS)]
    return with_arr.select(*df.columns, *out)


def weighted_scores(raw: tuple, weight: float) -> list[float]:
    """round(score * weight, 3) HALF_UP on exact decimals (F-13), as doubles."""
    w = Decimal(str(weight))
    return [float((Decimal(str(v)) * w).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP)) for v in raw]


def _double_array(vals: list[float]) -> Column:
    return F.array(*[F.lit(v).cast("double") for v in vals])


def score_map(scores: dict[str, tuple], weight: float) -> Column:
    """Score table as a literal map key -> array of six weighted scores."""
    entries = []
    for k, vals in scores.items():
        entries += [F.lit(k), _double_array(weighted_scores(vals, weight))]
    return F.create_map(*entries)


def amount_band(total: Column) -> Column:
    """M-4 bands: < 1000 low; > 1000 and < 4000 mid; else high (1000 exactly is high; missing -> 0 -> low)."""
    t = F.coalesce(total.cast("double"), F.lit(0.0))
    return F.when(t < 1000, "low").when((t > 1000) & (t < 4000), "mid").otherwise("high")


def score_device(spark, df: DataFrame, os_col: str = "os") -> DataFrame:
    """M-1: judge_os = first entry of the (comma-joined) os list; only iOS / Android are scored."""
    judge = F.split(F.col(os_col), ",").getItem(0)
    return score_join(spark, df.withColumn("judge_os", judge), F.col("judge_os"), DEVICE_SCORES, "device", WEIGHTS["device"])


def score_search(spark, df: DataFrame, category_col: str = "search_category") -> DataFrame:
    """M-2: search category scores; unknown or missing category scores 0."""
    return score_join(spark, df, F.col(category_col), SEARCH_SCORES, "search", WEIGHTS["search"], SEARCH_DEFAULT, null_default=True)


def score_pay_time(spark, df: DataFrame, slot_col: str = "pay_time_slot") -> DataFrame:
    """M-3."""
    return score_join(spark, df, F.col(slot_col), PAY_TIME_SCORES, "pay_time", WEIGHTS["pay_time"])


def score_amount(spark, df: DataFrame, total_col: str = "total_amount") -> DataFrame:
    """M-4."""
    return score_join(spark, df, amount_band(F.col(total_col)), AMOUNT_SCORES, "amount", WEIGHTS["amount"])


def score_brand(spark, df: DataFrame, brand_col: str = "tname") -> DataFrame:
    """M-5: listed brands, default row for others, absent when the brand is null."""
    return score_join(spark, df, F.col(brand_col), BRAND_SCORES, "tname", WEIGHTS["tname"], BRAND_DEFAULT)


def score_category(spark, df: DataFrame, category_col: str = "b1_name") -> DataFrame:
    """M-6: top-level category groups, default row for others, absent when null."""
    return score_join(spark, df, F.col(category_col), CATEGORY_SCORES, "b1name", WEIGHTS["b1name"], CATEGORY_DEFAULT)


def age_level(sums: list[Column]) -> Column:
    """M-7: bucket with the largest summed weight; the first bucket wins ties."""
    arr = F.array(*sums)
    idx = F.array_position(arr, F.array_max(arr))
    return F.element_at(F.array(*[F.lit(b) for b in BUCKETS]), idx.cast("int"))


def bucket_sums(left_prefixes: list[str], right_prefixes: list[str]) -> list[Column]:
    """Per bucket, the sum of all models' weights (null weight counts as 0)."""
    out = []
    for b in BUCKETS:
        parts = [F.coalesce(F.col(f"{p}_{b}"), F.lit(0.0)) for p in left_prefixes + right_prefixes]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        out.append(F.round(total, 6))
    return out
