"""Operators with SQL against it, over the whole sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import digest, duck, rows_of  # noqa: E402

from tidemark.llm.catalog import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck(SF).execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    assert digest(rows_of(got)) == digest(rows_of(want))
