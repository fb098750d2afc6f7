"""Map / JSON-object column functions (F-16, O-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_right_wins(left: Column, right: Column) -> Column:
    """F-16 ``left.putAll(right)``: duplicate keys take the right value.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by :func:`tillstream.session.prepare`);
    the default policy raises on duplicate keys.
    """
    return F.map_concat(left, right)


def prefix_keys(m: Column, prefix: str) -> Column:
    """F-16 prefix merge: every key gets ``prefix``."""
    return F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix), k))


def keep_keys(m: Column, csv_cols: Column) -> Column:
    """O-12: keep only keys listed in a CSV string column."""
    cols = F.split(csv_cols, ",")
    return F.map_filter(m, lambda k, v: F.array_contains(cols, k))
