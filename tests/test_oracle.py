"""Every registered key vs its DuckDB oracle on sf0.001 (rows, columns, order-insensitive values)."""

import decimal
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from tillstream.plans import ORACLE, QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_every_key_has_an_oracle():
    missing = [k for k in KEYS if k not in ORACLE]
    assert missing == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "uv_ct" in df.columns


@pytest.mark.parametrize("key", [k for k in KEYS if k in ORACLE])
def test_key_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(ORACLE[key])
    cols = [d[0] for d in res.description]
    want = _rows(res.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want
