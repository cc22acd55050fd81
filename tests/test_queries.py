"""Registry-level checks: every query with an oracle equals DuckDB on sf0.001; lint rules."""

import datetime as dt
import decimal
import math
import os
import re

import pytest

import __spark_entry__ as entry
from sparkpanel.plans import registry
from tests.conftest import SF_SMALL

registry.load_all()
ORACLE, QUERIES = registry.ORACLE, registry.QUERIES
#: queries without an oracle and the columns that hold shares
SHARES = ("accuracy", "precision", "recall", "f1", "auc", "importance", "r2")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "n_name"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 160


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows, scols = sdf.collect(), sdf.columns
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    order = sorted(scols)
    a = sorted((tuple(_norm(r[scols.index(c)]) for c in order) for r in srows), key=_key)
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=_key)
    for x, y in zip(a, b):
        assert len(x) == len(y)
        for u, v in zip(x, y):
            if isinstance(u, float) and isinstance(v, float):
                assert abs(u - v) <= 1e-9 * max(1.0, abs(u)), (name, x, y)
            else:
                assert u == v, (name, x, y)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_oracle_give_plausible_rows(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        assert all(r[c] is None or 0 <= r[c] <= 1 for c in SHARES if c in r)


def test_lint_no_unsafe_patterns():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sparkpanel")
    bad = []
    for dirpath, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(dirpath, f), encoding="utf-8").read()
                for pat in (r"F\.corr\(", r"localCheckpoint", r"\.crossJoin\(", r"@F\.udf", r"\.rdd\."):
                    if re.search(pat, src):
                        bad.append((f, pat))
    assert bad == []
