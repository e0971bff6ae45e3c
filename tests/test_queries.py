"""Every query with an oracle equals it on the smallest tables."""

import math
import os

import duckdb
import pytest

from curatrix.plans.registry import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return v if isinstance(v, (bool, str)) else round(float(v), 6)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_oracle(spark, duck, name):
    ours = queries()[name](spark, DATA)
    theirs = duck.execute(oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    order = sorted(names)
    got = sorted(str([plain(r[c]) for c in order]) for r in ours.collect())
    want = sorted(str([plain(row[names.index(c)]) for c in order]) for row in theirs.fetchall())
    assert got == want


def test_entry_imports_without_llm():
    import __spark_entry__

    assert set(oracle_sql()) <= set(__spark_entry__.queries())
