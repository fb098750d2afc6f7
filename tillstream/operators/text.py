"""Text operators: U-1 keyword tokenizer (built-in default) and its Python UDTF twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_SPLIT = r"\s+"


def tokens(text) -> Column:
    """Array of lower-cased whitespace tokens, empty tokens removed (JVM-side, codegen)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(col), TOKEN_SPLIT), lambda t: t != "")


def explode_keywords(df: DataFrame, text: str, out: str = "keyword") -> DataFrame:
    """U-1 as ``LATERAL TABLE``: one row per token, other columns repeated."""
    return df.withColumn(out, F.explode(tokens(text)))


def register_keyword_udtf(spark):
    """Register ``ik_analyze(text) -> (word)`` as a Python UDTF for SQL ``LATERAL`` use.

    Same tokens as :func:`tokens`. Only for SQL users who want the reference's
    function name; batch queries use the built-in form (no Python in the hot path).
    """
    import re

    from pyspark.sql.functions import udtf

    splitter = re.compile(TOKEN_SPLIT)

    @udtf(returnType="word: string")
    class IkAnalyze:
        def eval(self, text: str):
            if text is None:
                return
            for w in splitter.split(text.lower()):
                if w:
                    yield (w,)

    spark.udtf.register("ik_analyze", IkAnalyze)
    return IkAnalyze
