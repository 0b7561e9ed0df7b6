"""Every registered query equals its SQL oracle (DuckDB) on the same parquet tables."""

import pytest

import __spark_entry__ as E
from ledgerline.plans.catalog import QUERIES
from tests.conftest import SF001
from tests.oracle_util import canon, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    missing = set(KEYS) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF001).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    gc, gr = canon(got)
    wc, wr = canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0]["total_rows"] == 2951
