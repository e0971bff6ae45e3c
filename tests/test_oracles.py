"""No oracle proves nothing: each has rows, and none of its columns holds one value in all of them."""

import os

import duckdb
import pytest

from curatrix.plans.registry import oracle_sql

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Indicators that a trace can't give are null by definition.
NULL = {("run_indicators", n) for n in ("gpu_utilization", "false_accept_taskspec", "false_accept_legacy", "mutation_score", "cot_consistency_pass")}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_columns_vary(duck, name):
    rows = duck.execute(oracle_sql()[name]).fetchall()
    names = [d[0] for d in duck.description]
    assert rows
    if len(rows) > 1:
        constant = {n for i, n in enumerate(names) if len({str(r[i]) for r in rows}) == 1}
        assert not {n for n in constant if (name, n) not in NULL}
