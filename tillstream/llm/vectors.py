"""What the two vector operators share: valid vectors and packed blocks of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, and without null or non-finite components."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def runs(batches: Iterator[pd.DataFrame], keys: list[str], block: int) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, at most ``block`` at a time."""
    rest: pd.DataFrame | None = None
    for x in batches:
        x = x if rest is None else pd.concat([rest, x], ignore_index=True)
        rest = None
        if not len(x):
            continue
        change = np.flatnonzero((x[keys].to_numpy()[1:] != x[keys].to_numpy()[:-1]).any(1)) + 1
        cuts = [0, *change.tolist(), len(x)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            for k in range(lo, hi, block):
                part = x.iloc[k : min(k + block, hi)]
                if hi == len(x) and k + block >= hi:
                    rest = part
                else:
                    yield part
    if rest is not None:
        yield rest


def packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
