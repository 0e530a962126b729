"""Every registered query against its oracle SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check import compare
from tidemark.plans.oracle import ORACLE
from tidemark.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, name):
    outcome = compare(spark, FOLDER, name)
    assert outcome.startswith("ok"), outcome


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["entity", "volatility"] and df.count() == 5
