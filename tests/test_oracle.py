"""Every registered query against its DuckDB SQL oracle on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from oracle_check import digest, duck, rows_of  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(rows_of(sdf)) == digest(rows_of(odf))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "period_date" in df.columns
